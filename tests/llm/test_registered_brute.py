"""Registered queries that SQL cannot express, run over the smallest tables as they are, against
brute force."""

import hashlib
import json
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
from test_mixing import simulate
from test_quality import brute as statistics
from test_token_counts import brute as token_counts
from tokenizers import Tokenizer

from dayfacts.llm import mixing
from dayfacts.llm.queries import QUERIES


def test_op2(spark, small, sf_dir):
    found = QUERIES["op2_token_counts"](spark, sf_dir)
    assert sorted(map(tuple, found.select("doc_id", "n_words", "n_tokens").collect()), key=str) == token_counts(small["documents"])


def test_op4(spark, small, sf_dir):
    found = {r.doc_id: r for r in QUERIES["op4_quality"](spark, sf_dir).collect()}
    rows = small["documents"].collect()
    assert len(found) == len(rows)
    for doc in rows:
        r, (words, chars, symbols, lines, repeats) = found[doc.doc_id], statistics(doc.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (words, chars, symbols, lines, repeats)
        assert r.base_failed == (words < 20 or 100 * repeats > 30 * words) and not (r.base_failed and r.kept)


def test_op6(spark, small, sf_dir):
    slow = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in QUERIES["op6_packing"](spark, sf_dir).collect():
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append((r.offset, r.length))
    for doc in small["documents"].collect():
        ids, at = np.array([*slow.encode(doc.text or "", add_special_tokens=False).ids, 0], "<u4"), 0
        for r in sorted(pieces.pop(doc.doc_id), key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    assert not pieces
    for held in windows.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))]
        assert sum(n for _, n in held) <= 1024


def test_op9(spark, small, sf_dir):
    docs = {r.doc_id: r for r in small["documents"].collect()}
    rows = QUERIES["op9_mixing"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    sizes, streams = Counter(), defaultdict(list)
    for r in rows:
        assert r.source == docs[r.doc_id].source
        sizes[r.source] += max(docs[r.doc_id].n_chars or 1, 1)
        streams[r.source].append(r)
    names = sorted(sizes)
    total = sum(sizes[s] ** 0.5 for s in names)
    blocks = {i: -(-sizes[s] // 65_536) for i, s in enumerate(names)}
    slot = {b: n for n, b in enumerate(simulate(blocks, {i: round(mixing.PARTS * sizes[s] ** 0.5 / total) for i, s in enumerate(names)}))}
    for i, s in enumerate(names):
        at = 0
        for k, r in enumerate(sorted(streams[s], key=lambda r: r.mix_rank)):
            assert (r.mix_rank, r.mix_block, r.mix_slot) == (k, at // 65_536, slot[i, at // 65_536])
            at += max(docs[r.doc_id].n_chars or 1, 1)


def test_op10(spark, small, sf_dir):
    found = {r.doc_id: r for r in QUERIES["op10_media"](spark, sf_dir).collect()}
    rows, stored = small["documents"].collect(), {}
    assert len(found) == len(rows)
    for doc in rows:
        r, data = found[doc.doc_id], (doc.text or "").encode()
        payload = data.ljust(max(64, -(-len(data) // 64) * 64), b"\0")
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert r.media_bytes >= len(payload) and json.dumps(r.feature)
        assert stored.setdefault(payload, (r.media_sha256, r.feature)) == (r.media_sha256, r.feature)
