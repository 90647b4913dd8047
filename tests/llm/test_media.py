import hashlib
import zlib

import numpy as np
from pyspark.sql import functions as F

from dayfacts.llm import media as M


def test_known_codes():
    mu, a = M.mulaw_table(), M.alaw_table()
    assert [mu[c] for c in (0xFF, 0x7F, 0x00, 0x80, 0xF0)] == [0, 0, -32124, 32124, 120]
    assert [a[c] for c in (0xD5, 0x55, 0x2A, 0xAA, 0x80)] == [8, -8, -32256, 32256, 5504]


def one_block(block):
    """IMA ADPCM by the book, a nibble at a time."""
    steps, value, index = M.ima_steps(), int.from_bytes(block[:2], "little", signed=True), min(block[2], 88)
    out = [value]
    for byte in block[4:]:
        for code in (byte & 15, byte >> 4):
            step = int(steps[index])
            change = step >> 3
            change += step * (code >> 2 & 1) + (step >> 1) * (code >> 1 & 1) + (step >> 2) * (code & 1)
            value = max(-32768, min(32767, value - change if code & 8 else value + change))
            index = max(0, min(88, index + [-1, -1, -1, -1, 2, 4, 6, 8][code & 7]))
            out.append(value)
    return out


def test_blocks_decode_as_one_by_one():
    blocks = np.random.default_rng(1).integers(0, 256, (50, 64), dtype=np.uint8)
    assert M.decode_blocks(blocks).tolist() == [one_block(bytes(b)) for b in blocks]


def test_steps_grow_by_a_tenth():
    steps = M.ima_steps()
    assert len(steps) == 89 and all(b == int(a + (a // 10 or 1)) or abs(b / a - 1.1) < 0.1 for a, b in zip(steps, steps[1:]))


def test_resampling():
    x = np.array([0, 100, -100], dtype=np.int16)
    assert M.resample(x, 8000, 16000).tolist() == [0, 50, 100, 0, -100, -100]
    assert M.resample(x, 8000, 8000).tolist() == x.tolist()
    assert M.resample(np.arange(0, 160, dtype=np.int16), 16000, 8000).tolist() == list(range(0, 160, 2))
    assert M.resample(x[:0], 8000, 16000).tolist() == []


def test_payloads_come_back_whole(spark, small, awkward):
    for docs in (small["documents"], awkward):
        texts = [(r.doc_id, r.text or "") for r in docs.collect()]
        stored = M.document_media(docs)
        found = M.media_digests(stored).collect()
        want = []
        for doc, text in texts:
            data = text.encode()
            payload = data + b"\0" * (-len(data) % 64 if data else 64)
            want.append((doc, len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])))
        key = lambda r: str(tuple(r))
        assert sorted(((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in found), key=key) == sorted(want, key=key)
        by_text = {}
        for r in found:
            assert by_text.setdefault(r.payload_sha256, (r.media_sha256, r.feature)) == (r.media_sha256, r.feature)


def test_stored_and_decoded_files_are_wav(spark):
    rows = spark.createDataFrame([("mulaw", bytearray(b"\xff\x80\x00")), ("alaw", bytearray(b"\xd5\x55")), ("ima_adpcm", bytearray(64)), ("mp3", bytearray(4)), ("mulaw", None)], "codec string, data binary")
    files = rows.select("codec", M.wav(F.col("data"), F.col("codec")).alias("media"), F.lit("mine").alias("peak"))
    got = M.decode(files).collect()
    pcm = [np.frombuffer(bytes(r.pcm)[44:], "<i2").tolist() if r.pcm is not None else None for r in got]
    assert pcm[0] == [0, 16062, 32124, 0, -32124, -32124] and pcm[1] == [8, 0, -8, -8] and len(pcm[2]) == 242
    assert pcm[3:] == [None, None] and got[0].peak == 32124
    for r in got[:3]:
        assert int.from_bytes(bytes(r.media)[4:8], "little") == len(r.media) - 8
        tag, rate, block, samples = M.chunks(bytes(r.media))
        assert (tag, rate, bytes(samples)) == (M.TAGS[r.codec], 8000, bytes(r.samples))


def test_what_is_no_wav_gives_nulls(spark):
    df = spark.createDataFrame([(bytearray(b"RIFFxxxxWAVE"),), (bytearray(b""),), (bytearray(b"junk" * 9),)], "media binary")
    assert [r.pcm for r in M.decode(df).collect()] == [None] * 3
    assert M.decode(df.limit(0)).count() == 0
