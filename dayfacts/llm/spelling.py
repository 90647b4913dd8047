"""Words that are one edit apart, and the form that each is likely to stand for.

Asymmetric chunks: of two words with one edit between them, the longer (or either, if they are as
long) gives two disjoint chunks of half its length, its beginning and its end. An edit leaves one
of them whole, and the other word holds it as a positional gram: in the same place, or, for the
chunk at the end, shifted by the one character that was deleted. Of the other word's grams only
those in such places can be met, so only they are written. Chunks and grams are joined, and the
join itself verifies the words.

Many words with the same chunk are not compared with each other: what is left of them, once the
chunk is taken off, is again one edit apart, so it gives two chunks again, and so on, until few
words meet or one character is left, where at most an alphabet of words can.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER, at_end, cut, join_sized, ship
from .linking import parts

ship(__name__)

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans(UPPER, UPPER.lower())
#: Comparisons for one chunk beyond which what is left of the words gives chunks again.
MANY = 1 << 14


def as_written(prefix: int, low: str, raw: bytes) -> str:
    return low


def with_lost_letters(prefix: int, low: str, raw: bytes) -> str:
    """The word without one of its letters, where 97 divides the crc32 of ``<doc_id>:<word>``.
    ``prefix`` is that of ``<doc_id>:``."""
    h = zlib.crc32(raw, prefix)
    if h % 97:
        return low
    at = h % len(low)
    return low[:at] + low[at + 1 :]


def word_counts(docs: DataFrame, *, least_chars: int = 5, least_times: int = 3, written: Callable[[int, str, bytes], str] = as_written, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n for the words of whole texts: maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF),
    A-Z lower-cased, of ``least_chars`` code points or more, that occur ``least_times`` or more.

    ``written(prefix, low, raw)`` may change a word of a document: prefix is the crc32 of
    ``<doc_id>:`` (of ``:`` for a null id), raw the word in UTF-8. Null and empty texts: no words.
    Repeated rows count again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[str, bytes]] = {}
        total: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for part in parts(batch, 1, 1 << 20):
                for doc, text in zip(part.column(0).to_pylist(), part.column(1)):
                    prefix = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for found, times in Counter(RUN.findall(text.as_py() or "")).items():
                        pair = known.get(found)
                        if pair is None:
                            low = found.translate(_LOWER)
                            pair = low, low.encode()
                            if len(known) < 200_000 and len(found) <= 64:
                                known[found] = pair
                        word = written(prefix, *pair)
                        if len(word) >= least_chars:
                            total[word] += times
                if len(total) > 200_000:
                    yield flush()
        yield flush()

    texts = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    each = texts.mapInArrow(at_end(run), "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_times)


def halved(rows: DataFrame) -> DataFrame:
    """Rows of word, n, long, m, key, rest with the chunk at the beginning or the end of what was
    left taken into the key. ``m`` is the length of what is left of the long word; a short word's
    may be shorter by one."""
    q = (F.col("m") / 2).cast("int")
    rest, size = F.col("rest"), F.length("rest")
    first = F.struct(F.xxhash64("key", F.lit(0), F.substr(rest, F.lit(1), q)).alias("key"), F.substr(rest, q + 1).alias("rest"))
    last = F.struct(F.xxhash64("key", F.lit(1), F.substr(rest, size - q + 1)).alias("key"), F.substr(rest, F.lit(1), size - q).alias("rest"))
    return rows.withColumn("at", F.explode(F.array(first, last))).select("word", "n", "long", (F.col("m") - q).alias("m"), "at.key", "at.rest")


def near_words(words: DataFrame, *, many: int = MANY) -> DataFrame:
    """a, n_a, b, n_b: every two words one inserted, deleted or replaced code point apart, once.
    ``words`` is a checkpointed table of word, n, one row a word, of two code points or more."""
    size = F.length("word")
    as_long = F.struct(F.lit(True).alias("long"), size.alias("m"))
    as_short = [F.struct(F.lit(False).alias("long"), (size + k).alias("m")) for k in (0, 1)]
    rows = words.withColumn("as", F.explode(F.array(as_long, *as_short)))
    rows = rows.select("word", "n", "as.long", "as.m", F.xxhash64("as.m").alias("key"), F.col("word").alias("rest"))
    found: DataFrame | None = None
    while True:
        rows = cut(halved(rows))
        sides = rows.groupBy("key").agg(F.count_if("long").alias("x"), F.count_if(~F.col("long")).alias("y"), F.max("m").alias("most"))
        met = cut(sides.filter("x > 0 and y > 0").select("key", ((F.col("x") * F.col("y") > many) & (F.col("most") > 1)).alias("hot")))
        placed = join_sized(rows, met, "key", "inner")
        x = placed.filter("long and not hot").select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
        y = placed.filter("not long and not hot").select("key", F.col("word").alias("b"), F.col("n").alias("n_b"))
        once = (F.length("a") > F.length("b")) | (F.col("a") < F.col("b"))
        own = x.join(y, "key").filter(once & (F.levenshtein("a", "b", 1) == 1)).select("a", "n_a", "b", "n_b")
        found = own if found is None else found.unionByName(own)
        hot = placed.filter("hot").drop("hot")
        if met.filter("hot").isEmpty():
            return found.distinct()
        rows = hot


def roots(forms: DataFrame) -> DataFrame:
    """word, root for word, form: what following forms from a word ends at. Forms make no circles.
    The steps double in each round."""
    out = cut(forms.filter("form is not null").select("word", F.col("form").alias("root")))
    while True:
        beyond = out.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        out = cut(out.join(beyond, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        if out.filter("moved").isEmpty():
            return out.drop("moved")
        out = out.drop("moved")


def variants(words: DataFrame, *, times: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of word, n (a word once).

    Near words differ by exactly one inserted, deleted or replaced code point. The form is the near
    word of largest n (of several the smallest in code-point order) if its n is at least ``times``
    (2 or more) the word's; root is what forms lead to, the word itself if it has none. A word has
    at most some 90 near words for each of its characters, so none gathers many rows. Null words
    are left out. Empty table: no rows.
    """
    words = cut(words.filter("word is not null").select("word", "n"))
    pairs = near_words(words)
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("n")), F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("n")))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "near")).alias("f"))
    joined = words.join(best, "word", "left")
    taken = -F.col("f.less") >= times * F.col("n")
    forms = cut(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(taken, F.col("f.near")).alias("form"), F.when(taken, -F.col("f.less")).alias("form_n")))
    return forms.join(roots(forms), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
