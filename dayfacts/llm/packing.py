"""Packing token ids into windows by sum-of-squares online placement.

Each task packs the documents of its own partition as they arrive, so nothing is shuffled and
no window crosses tasks. A document is cut into full windows first; its remainder goes to the
fill level that minimises the sum of squared counts of partially filled windows, tracked in an
array over the levels. Whatever is open when a task ends is consolidated by cutting.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import at_end, ship

ship(__name__)

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)
ARROW = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
)

#: Text for which both tokenizer libraries agree on what is a letter, a number or a space.
PLAIN = re.compile(r"[\n\r\t\x20-\x7e\xa1-\xac\xae-ȳ‐-‧€]*")

#: The public split into pre-tokens but for white space, whose last character it leaves to what follows.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
#: After this a pre-token ends in any case; between two such ends white space needs no look-ahead.
BEFORE_LAST_SPACE = re.compile(r"\s(?=\s\S)")


def special_tokens(json_path: str) -> dict[str, int]:
    """Special tokens of a tokenizer file; its vocabulary and merges, which come last, stay unparsed."""
    with open(json_path, encoding="utf-8") as f:
        text = f.read()
    try:
        found = json.loads(re.split(r',\s*"vocab"\s*:', text, maxsplit=1)[0] + "}}")["added_tokens"]
    except (ValueError, KeyError):  # in another order
        found = json.loads(text)["added_tokens"]
    return {t["content"]: t["id"] for t in found}


def byte_bpe_encoder(json_path: str, ranks_path: str | None, pattern: str | None) -> Callable[[str], np.ndarray]:
    """text -> uint32 ids of a byte-level BPE tokenizer file.

    The same vocabulary given as ranks is encoded several times faster. Its merges are the same
    because every token of a trained BPE is what its own bytes merge to (tested over the whole
    vocabulary); the two libraries' character classes could differ only outside ``PLAIN``, and
    such texts, like those that hold the special token, go to the tokenizer file itself. That takes
    more memory than all the rest and is opened when the first of them comes.

    The ranks' encoder is given the special tokens, though no text that it gets holds one: with
    none it looks for the empty string at every character. A pattern with a look-ahead takes the
    slower of its two regex engines, so texts are cut where white space leaves its last character
    to what follows, and the parts split without it; texts with many such places stay whole.
    """
    special = special_tokens(json_path)
    slow = fast = plain = None
    if ranks_path:
        import base64

        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        if pattern == WORDS + r"|\s+(?!\S)|\s+":
            plain = tiktoken.Encoding("parts", pat_str=WORDS + r"|\s+", mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> np.ndarray:
        nonlocal slow
        if fast is not None and PLAIN.fullmatch(text) and not any(s in text for s in special):
            most = len(text) // 64
            ends = [m.end() for m in islice(BEFORE_LAST_SPACE.finditer(text), most + 1)] if plain else []
            if plain is None or len(ends) > most:
                return fast.encode_to_numpy(text, disallowed_special=())
            return np.concatenate([plain.encode_to_numpy(text[a:b], disallowed_special=()) for a, b in zip([0, *ends], [*ends, len(text)])])
        if slow is None:
            from tokenizers import Tokenizer

            slow = Tokenizer.from_file(json_path)
        return np.array(slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    return encode


class LevelPacker:
    """Sum-of-squares placement of pieces into windows of ``size`` ids.

    ``counts[h]`` is the number of open windows filled to level h. Moving a window from level h
    to h+n changes the sum of squares by 2 * (counts[h+n] - counts[h] + 1); a new window and a
    window that becomes full change one term only. Ties go to the fullest window.
    """

    def __init__(self, size: int):
        self.size = size
        self.counts = np.zeros(size + 1, dtype=np.int64)
        self.open: list[list[list]] = [[] for _ in range(size + 1)]
        self.made = 0

    def place(self, piece: tuple) -> list | None:
        """Put a piece (doc, start, ids, total) of 1..size ids somewhere; the window if it is now full."""
        n, size, counts = len(piece[2]), self.size, self.counts
        level = 0
        if n < size:
            change = 2 * (counts[n:size + 1] - counts[: size + 1 - n] + 1)  # to levels n..size, from 0..size-n
            change[0] = 2 * counts[n] + 1
            change[-1] = 1 - 2 * counts[size - n]
            change[1:][counts[1 : size + 1 - n] == 0] = np.iinfo(np.int64).max
            level = size - n - int(np.argmin(change[::-1]))
        if level:
            window = self.open[level].pop()
            counts[level] -= 1
        else:
            window = [self.made]
            self.made += 1
        window.append(piece)
        if level + n == size:
            return window
        self.open[level + n].append(window)
        counts[level + n] += 1
        return None

    def rest(self) -> Iterator[list]:
        """Close the open windows with next to no padding: the emptiest are cut to fill the fullest.

        The last window's ids are cut into runs of powers of two, lengths that need no padding.
        """
        left = [(h, w) for h in range(self.size, 0, -1) for w in self.open[h]]
        a, b = 0, len(left) - 1
        while a < b:
            (h, window), (g, donor) = left[a], left[b]
            doc, start, ids, total = donor.pop()
            n = min(self.size - h, len(ids))
            window.append((doc, start + len(ids) - n, ids[len(ids) - n :], total))
            if n < len(ids):
                donor.append((doc, start, ids[: len(ids) - n], total))
            left[a], left[b] = (h + n, window), (g - n, donor)
            if h + n == self.size:
                yield window
                a += 1
            if g == n:
                b -= 1
        if a == b:
            level, window = left[a]
            pieces = window[1:]
            for bit in (1 << k for k in range(level.bit_length() - 1, -1, -1) if level >> k & 1):
                out, need = [self.made], bit
                self.made += 1
                while need:
                    doc, start, ids, total = pieces.pop()
                    n = min(need, len(ids))
                    out.append((doc, start, ids[:n], total))
                    if n < len(ids):
                        pieces.append((doc, start + n, ids[n:], total))
                    need -= n
                yield out


def pack(docs: DataFrame, encoder: Callable[[], Callable[[str], np.ndarray]], *, size: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack whole texts into sequences of at most ``size`` ids.

    One row per piece: doc_id, start, ids (little-endian uint32), doc_tokens, sequence_id,
    offset. Every id of a document, its end id included, lies in exactly one piece.

    Null or empty text: the end id alone. Null ids and repeated rows: each row is a document of
    its own. Empty table: no rows. Other columns are not read, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer, rows, held = encoder(), LevelPacker(size), [], 0
        base = TaskContext.get().partitionId() << 40

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 6
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW)], schema=ARROW)

        def emit(window: list) -> int:
            at = 0
            for doc, start, ids, total in window[1:]:
                rows.append((doc, start, ids.tobytes(), total, base + window[0], at))
                at += len(ids)
            return at

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4", copy=False)
                for start in range(0, len(ids), size):
                    full = packer.place((doc, start, ids[start : start + size].copy(), len(ids)))
                    if full:
                        held += emit(full)
                if held >= 1 << 19:
                    yield flush()
                    held = 0
        for window in packer.rest():
            held += emit(window)
            if held >= 1 << 19:
                yield flush()
                held = 0
        yield flush()

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(at_end(run), PIECES)


def public_encoder(name: str = "byte_bpe_50k") -> Callable[[], Callable[[str], np.ndarray]]:
    """The encoder of a public byte-level vocabulary, opened by each task on its own machine."""

    def make():
        import public_tokenizers

        return byte_bpe_encoder(public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN)

    return make


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The contract's columns: the ids of a piece as their length and CRC-32."""
    return pieces.select(
        "doc_id",
        "start",
        F.expr("octet_length(ids) div 4").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
