import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from dayfacts.llm import packing as K


def check(rows, texts, size=1024):
    """Every id in one piece, gapless sequences, and next to no padding; ``texts`` by document."""
    slow = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, bytes(r.ids), r.doc_tokens))
        windows[r.sequence_id].append((r.offset, len(r.ids) // 4))
    for doc, text in texts.items():
        ids = np.array([*slow.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        found = sorted(pieces.pop(doc))
        assert b"".join(x for _, x, _ in found) == ids
        assert [s for s, _, _ in found] == [sum(len(x) // 4 for _, x, _ in found[:i]) for i in range(len(found))]
        assert {t for _, _, t in found} == {len(ids) // 4}
    assert not pieces
    fills = []
    for w in windows.values():
        w.sort()
        assert [o for o, _ in w] == [sum(n for _, n in w[:i]) for i in range(len(w))]
        fills.append(sum(n for _, n in w))
    assert max(fills) <= size
    return sum(0 if n & (n - 1) == 0 else size - n for n in fills)


def test_documents_lie_whole_in_windows_without_padding(small):
    docs = small["documents"]
    rows = K.pack(docs, K.public_encoder()).collect()
    assert check(rows, {r.doc_id: r.text for r in docs.collect()}) == 0


def test_digests_follow_the_ids(small):
    rows = K.pack(small["documents"].limit(20), K.public_encoder())
    both = {(r.doc_id, r.start): r for r in K.piece_digests(rows).collect()}
    for r in rows.collect():
        assert both[r.doc_id, r.start].ids_crc32 == zlib.crc32(bytes(r.ids)) and both[r.doc_id, r.start].length * 4 == len(r.ids)


def test_awkward_documents(spark, awkward):
    once = awkward.filter("doc_id is not null").dropDuplicates(["doc_id"])
    assert check(K.pack(once, K.public_encoder()).collect(), {r.doc_id: r.text for r in once.collect()}) == 0
    every = K.pack(awkward, K.public_encoder()).collect()
    assert sum(r.start == 0 for r in every) == awkward.count()
    assert K.pack(awkward.limit(0), K.public_encoder()).count() == 0


def test_each_token_is_what_its_own_bytes_merge_to():
    """Then merging by rank and merging by the list of merges agree on every text."""
    with open(P.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        model = json.load(f)["model"]
    rank = {tuple(m.split(" ")) if isinstance(m, str) else tuple(m): i for i, m in enumerate(model["merges"])}
    for token in model["vocab"]:
        parts = list(token)
        while len(parts) > 1:
            i = min(range(len(parts) - 1), key=lambda i: (rank.get((parts[i], parts[i + 1]), 1 << 30), i))
            if (parts[i], parts[i + 1]) not in rank:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert parts == [token]


def test_both_encoders_agree_on_odd_texts():
    encode = K.public_encoder()()
    slow = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    odd = ["", " ", "\n\n a", "a  b\t\tc", "it's I'LL we've", "<|endoftext|>x", "日本語 текст", "\x1c\x1d", "é\u0301", "½ ² ¼", "a\u00a0b\u0085c", "¡Hola! «x»", "ß ſ ǆ ȳ"]
    odd += ["".join(rng.choice("ab 1'\n\t.é½²—€\u00a0ÿſ!") for _ in range(60)) for _ in range(400)]
    for text in odd:
        assert encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids, repr(text)


def test_white_space_is_cut_as_the_pattern_does():
    encode = K.public_encoder()()
    slow = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rng = random.Random(7)
    texts = ["a  b", "a   \n", "  a", "\n\n\na \n b\r\n\r\n  c\t", "x" + " " * 3000 + "y", "a \n" * 500, "''t  'll 's"]
    texts += ["".join(rng.choice("aZé1½'.!  \n\r\t\t") for _ in range(80)) for _ in range(400)]
    texts += ["".join(rng.choice(["word ", "It's", " 12", "...", "ü", "a  b", " \n c", "\n\n"] + ["plain words here"] * 20) for _ in range(60)) for _ in range(200)]  # cut
    for text in texts:
        assert encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids, repr(text)


def test_encoding_needs_no_slow_search(monkeypatch):
    """Neither a look-ahead, nor an empty set of special tokens that is looked for at every character."""
    import tiktoken

    made = []

    class Seen(tiktoken.Encoding):
        def __init__(self, *a, **b):
            made.append(b)
            super().__init__(*a, **b)

    monkeypatch.setattr(tiktoken, "Encoding", Seen)
    K.public_encoder()()
    assert all(m["special_tokens"] == {"<|endoftext|>": 50256} for m in made)
    assert any("(?" not in m["pat_str"] for m in made)


def test_the_whole_tokenizer_is_opened_only_for_texts_that_need_it(monkeypatch):
    import tokenizers

    opened = []

    class Seen:
        @staticmethod
        def from_file(path):
            opened.append(path)
            return Tokenizer.from_file(path)

    monkeypatch.setattr(tokenizers, "Tokenizer", Seen)
    encode, slow = K.public_encoder()(), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for text, times in (("plain words, é", 0), ("текст", 1), ("<|endoftext|>x", 1)):
        assert encode(text).tolist() == slow.encode(text, add_special_tokens=False).ids and len(opened) == times


def test_special_tokens_wherever_the_file_has_them(tmp_path):
    tokens = [{"id": 7, "content": ',"vocab":'}]
    for name, at in (("first", {"added_tokens": tokens, "model": {"type": "BPE", "vocab": {"a": 0}}}), ("last", {"model": {"vocab": {"a": 0}}, "added_tokens": tokens})):
        for indent in (None, 2):
            (tmp_path / name).write_text(json.dumps(at, indent=indent))
            assert K.special_tokens(str(tmp_path / name)) == {',"vocab":': 7}
    assert K.special_tokens(P.path("byte_bpe_50k.json")) == {"<|endoftext|>": 50256}


def test_placement_minimises_the_sum_of_squares():
    rng = random.Random(5)
    packer = K.LevelPacker(16)
    for _ in range(400):
        n = rng.randint(1, 16)
        counts = packer.counts.copy()

        def squares(level):
            c = counts.copy()
            if level:
                c[level] -= 1
            if level + n < 16:
                c[level + n] += 1
            return int((c[1:16] ** 2).sum())

        options = [h for h in range(17 - n) if h == 0 or counts[h]]
        best = min(map(squares, options))
        packer.place((0, 0, np.zeros(n, np.uint32), n))
        assert int((packer.counts[1:16] ** 2).sum()) == best
