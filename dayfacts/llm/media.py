"""Telephony audio columns: mu-law, A-law and IMA ADPCM in WAV containers, decoded to PCM.

Storing is a Spark expression (a WAV header before the samples). Decoding runs over Arrow
batches: mu-law and A-law expand through 256-entry lookup tables, ADPCM blocks of a whole batch
are decoded side by side, one numpy step per sample position. Nothing is shuffled.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship

ship(__name__)

#: WAV format tags.
TAGS = {"alaw": 6, "mulaw": 7, "ima_adpcm": 17}
#: Bytes of an ADPCM block, and before the samples of a file that we write.
BLOCK = 64
HEADER = 60
#: The index changes of IMA ADPCM by code.
INDEX_CHANGE = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2)


def ima_steps() -> np.ndarray:
    """The 89 step sizes: each about a tenth larger than the one before, as the format lists them."""
    #: Fixed values of the format.
    return np.array(
        "7 8 9 10 11 12 13 14 16 17 19 21 23 25 28 31 34 37 41 45 50 55 60 66 73 80 88 97 107 118 130 143 157 173 190 209 230 253 279 307 337 371 408 449 494 544 598 658 724 796 876 963 1060 1166 1282 1411 1552 1707 1878 2066 2272 2499 2749 3024 3327 3660 4026 4428 4871 5358 5894 6484 7132 7845 8630 9493 10442 11487 12635 13899 15289 16818 18500 20350 22385 24623 27086 29794 32767".split(),
        dtype=np.int64,
    )


def mulaw_table() -> np.ndarray:
    code = ~np.arange(256) & 0xFF
    size = ((((code & 0x0F) << 3) + 0x84) << ((code >> 4) & 7)) - 0x84
    return np.where(code & 0x80, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    code = np.arange(256) ^ 0x55
    exponent, mantissa = (code >> 4) & 7, (code & 0x0F) << 4
    size = np.where(exponent == 0, mantissa + 8, (mantissa + 0x108) << np.maximum(exponent - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


def decode_blocks(blocks: np.ndarray) -> np.ndarray:
    """(n, BLOCK) bytes of mono IMA ADPCM -> (n, samples of a block) int16, all blocks at once.

    A header's step index beyond the table is taken as the table's last.
    """
    steps, n = ima_steps(), len(blocks)
    out = np.empty((2 * (blocks.shape[1] - 4) + 1, n), dtype=np.int16)
    value = np.ascontiguousarray(blocks[:, :2]).view("<i2")[:, 0].astype(np.int64)
    index = np.minimum(blocks[:, 2].astype(np.int64), 88)
    out[0] = value
    codes = np.ascontiguousarray(blocks[:, 4:].T)
    for k in range(1, len(out)):
        code = codes[(k - 1) // 2]
        code = (code & 0x0F if k % 2 else code >> 4).astype(np.int64)
        step = steps[index]
        change = (step >> 3) + np.where(code & 4, step, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 1, step >> 2, 0)
        value = np.clip(value + np.where(code & 8, -change, change), -32768, 32767)
        index = np.clip(index + INDEX_CHANGE[code], 0, 88)
        out[k] = value
    return np.ascontiguousarray(out.T)


def resample(x: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Linear interpolation in whole numbers; the last sample is held."""
    if rate == target or not len(x):
        return x
    if target % rate == 0:
        k = target // rate
        a, b = x.astype(np.int32), np.append(x[1:], x[-1:]).astype(np.int32)
        out = np.empty(len(x) * k, dtype=np.int16)
        for j in range(k):
            out[j::k] = (a * (k - j) + b * j) // k
        return out
    at = np.arange(-(-len(x) * target // rate), dtype=np.int64) * rate
    left, part = at // target, at % target
    a = x.astype(np.int64)
    return ((a[left] * (target - part) + a[np.minimum(left + 1, len(x) - 1)] * part) // target).astype(np.int16)


def chunks(wav: bytes) -> tuple[int, int, int, bytes]:
    """Format tag, sample rate, block size and sample bytes of a RIFF/WAVE file of one channel."""
    if wav[:4] != b"RIFF" or wav[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at, tag, channels, rate, block = 12, 0, 0, 0, 1
    while at + 8 <= len(wav):
        name, n = wav[at : at + 4], struct.unpack_from("<I", wav, at + 4)[0]
        if name == b"fmt ":
            tag, channels, rate, _, block = struct.unpack_from("<HHIIH", wav, at + 8)
        if name == b"data":
            if rate < 1 or channels != 1:
                raise ValueError("not one channel of samples at a rate")
            return tag, rate, block, wav[at + 8 : at + 8 + n]
        at += 8 + n + n % 2
    raise ValueError("a WAVE file without samples")


def _le(n: Column | int, width: int) -> Column:
    """A whole number as little-endian bytes."""
    n = F.lit(n) if isinstance(n, int) else n
    parts = [F.lpad(F.hex(F.shiftright(n.cast("long"), 8 * k).bitwiseAND(F.lit(255))), 2, "0") for k in range(width)]
    return F.unhex(F.concat(*parts))


def wav(samples: Column, codec: Column, rate: int = 8000) -> Column:
    """The WAV file that holds these sample bytes as they are; null for an unknown codec or null samples."""
    n = F.octet_length(samples).cast("long")

    def file(name: str) -> Column:
        block, bits = (BLOCK, 4) if name == "ima_adpcm" else (1, 8)
        per_block = 2 * (BLOCK - 4) + 1
        speed = rate * BLOCK // per_block if name == "ima_adpcm" else rate
        count = F.expr("0L") + (F.floor(n / BLOCK) * per_block if name == "ima_adpcm" else n)
        fmt = struct.pack("<HHIIHHHH", TAGS[name], 1, rate, speed, block, bits, 2, per_block if name == "ima_adpcm" else 0)
        head = b"WAVEfmt " + struct.pack("<I", len(fmt)) + fmt + b"fact" + struct.pack("<I", 4)
        pad = F.when(n % 2 == 1, F.lit(b"\0")).otherwise(F.lit(b""))
        return F.concat(F.lit(b"RIFF"), _le(n + n % 2 + HEADER - 8, 4), F.lit(head), _le(count, 4), F.lit(b"data"), _le(n, 4), samples, pad)

    out = F.when(F.lit(False), F.lit(None).cast("binary"))
    for name in TAGS:
        out = out.when(codec == name, file(name))
    return out


DECODED = [("samples", "binary", pa.binary()), ("pcm", "binary", pa.binary()), ("n_samples", "long", pa.int64()), ("peak", "long", pa.int64()), ("energy", "long", pa.int64()), ("crossings", "long", pa.int64())]


def decode(df: DataFrame, media_col: str = "media", *, target_rate: int = 16000) -> DataFrame:
    """Add what a telephony WAV column holds: samples (the stored bytes, read back), pcm (a
    16-bit WAV at ``target_rate``), n_samples, peak, energy and crossings of the PCM.

    Null media, and a file that is no WAV, has another codec, several channels, no rate, or ADPCM
    samples that are not whole blocks: nulls in all added columns. A file without samples: empty samples, PCM of no samples, zeros. Columns of the input whose
    names clash with the added ones are replaced.
    """
    kept = df.drop(*[name for name, _, _ in DECODED])
    at = kept.columns.index(media_col)
    schema = T.StructType([*kept.schema.fields, *T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t, _ in DECODED)).fields])

    def measured(x: np.ndarray) -> tuple:
        y = x.astype(np.int64)
        return len(x), int(np.abs(y).max(initial=0)), int((y * y).sum()), int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))

    def pcm_file(x: np.ndarray) -> bytes:
        data = x.astype("<i2").tobytes()
        return b"RIFF" + struct.pack("<I", 36 + len(data)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, target_rate, 2 * target_rate, 2, 16) + b"data" + struct.pack("<I", len(data)) + data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {TAGS["mulaw"]: mulaw_table(), TAGS["alaw"]: alaw_table()}
        for batch in batches:
            begin = 0
            sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(at)]
            while begin < batch.num_rows:  # about 4 MB of files at a time
                end, total = begin, 0
                while end < batch.num_rows and (end == begin or total + sizes[end] <= 1 << 22):
                    total += sizes[end]
                    end += 1
                part = batch.slice(begin, end - begin)
                begin = end
                found: list[tuple | None] = []
                for value in part.column(at).to_pylist():
                    try:
                        found.append(None if value is None else chunks(value))
                    except (ValueError, struct.error):
                        found.append(None)
                groups: dict[int, list[int]] = {}
                for i, f in enumerate(found):
                    if f and f[0] == TAGS["ima_adpcm"] and f[2] > 4 and len(f[3]) % f[2] == 0:
                        groups.setdefault(f[2], []).append(i)
                wave: dict[int, np.ndarray] = {}
                for size, members in groups.items():
                    blocks = np.frombuffer(b"".join(found[i][3] for i in members), dtype=np.uint8).reshape(-1, size)
                    decoded, k = decode_blocks(blocks), 0
                    for i in members:
                        n = len(found[i][3]) // size
                        wave[i], k = decoded[k : k + n].reshape(-1), k + n
                columns: list[list] = [[] for _ in DECODED]
                for i, f in enumerate(found):
                    if f and f[0] in tables:
                        wave[i] = tables[f[0]][np.frombuffer(f[3], dtype=np.uint8)]
                    row = (None,) * len(DECODED)
                    if i in wave:
                        x = resample(wave[i], f[1], target_rate)
                        row = (f[3], pcm_file(x), *measured(x))
                    for column, value in zip(columns, row):
                        column.append(value)
                arrays = [pa.array(c, t) for c, (_, _, t) in zip(columns, DECODED)]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=[*part.schema.names, *[n for n, _, _ in DECODED]])

    return kept.mapInArrow(run, schema)


def document_media(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rate: int = 8000, target_rate: int = 16000) -> DataFrame:
    """Whole texts as telephony files: doc_id, n_bytes, media, samples, pcm and the PCM's measures.

    The payload is the text's UTF-8 bytes and zero bytes up to a positive multiple of BLOCK; its
    CRC-32 picks the codec, so equal texts give equal files. Null and empty text: one block of
    zeros. Repeated rows: a row each. Empty table: no rows. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    data = F.encode(text, "UTF-8")
    n = F.octet_length(data)
    padded = F.greatest(F.lit(BLOCK), F.ceil(n / BLOCK) * BLOCK)
    zeros = F.unhex(F.repeat(F.lit("00"), (padded - n).cast("int")))
    payload = docs.select(F.col(id_col).alias("doc_id"), n.cast("long").alias("n_bytes"), F.concat(data, zeros).alias("payload"))
    codec = F.element_at(F.array(*[F.lit(c) for c in ("mulaw", "alaw", "ima_adpcm")]), (F.crc32("payload") % 3 + 1).cast("int"))
    media = payload.select("doc_id", "n_bytes", wav(F.col("payload"), codec, rate).alias("media"))
    return decode(media, "media", target_rate=target_rate)


def media_digests(media: DataFrame) -> DataFrame:
    """The contract's columns, from the stored file and the sample bytes read back from it."""
    samples = F.col("samples")
    tag = F.hex(F.substring("media", 21, 1))
    return media.select(
        "doc_id",
        "n_bytes",
        F.octet_length(samples).cast("long").alias("payload_bytes"),
        F.sha2(samples, 256).alias("payload_sha256"),
        F.crc32(F.substring(samples, -BLOCK, BLOCK)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(":", tag, "n_samples", "peak", "energy", "crossings", F.crc32("pcm")).alias("feature"),
    )
