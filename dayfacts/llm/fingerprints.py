"""Bottom-k sketches of shingle hashes as document fingerprints: the k smallest distinct hashes.

Sketches merge: the sketch of a union is made of the sketches of its parts. Of two sketches come
the resemblance and the containment of their sets, of one the number of distinct shingles.
Everything is built of SQL functions; no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, ascii_lower, cut, join_sized, text_key

#: Words of a shingle; hashes of a sketch.
SIZE, K = 5, 128
#: Ids of a span; rows of one from which it is split by id, and rows of an id in a part of it.
SPAN_BITS, CROWDED, SLICE = 10, 4096, 2048


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased: maximal runs of what is not white space."""
    bare = F.btrim(ascii_lower(text), F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACE}]+"))


def sketch(words: Column, size: int = SIZE, k: int = K) -> Column:
    """The ``k`` smallest distinct 64-bit hashes of the ``size``-word shingles, ascending. Fewer words
    than ``size``: the whole sequence is one shingle; none: an empty sketch."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - size, F.lit(0)))
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(size)]))
    return F.when(F.size(words) > 0, F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)).otherwise(F.array().cast("array<bigint>"))


def sketched(df: DataFrame, text: str, to: str, size: int = SIZE, k: int = K) -> DataFrame:
    """The rows with a column ``to``, the sketch of the column ``text``. The words are a column of
    their own first, so that they are split once, not for every shingle."""
    return df.withColumn("_words", words_of(F.col(text))).withColumn(to, sketch(F.col("_words"), size, k)).drop("_words")


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merged_by(sketches: DataFrame, keys: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """keys, sketch: that of the union of each group's sets. Only the ``k`` smallest hashes of a part
    of a group leave a task, so no group is gathered. Groups of empty or null sketches alone, and
    null sketches beside others: as empty sets. Null keys are a group; empty table: no rows."""
    hashes = sketches.select(*keys, F.explode(F.col(column)).alias("_h")).distinct()
    salted = hashes.withColumn("_s", F.pmod(F.xxhash64("_h"), F.lit(32)))
    some = salted.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_s").orderBy("_h"))).filter(F.col("_r") <= k)
    best = some.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("_h"))).filter(F.col("_r") <= k)
    found = best.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias("sketch"))
    names = [F.col(c).alias(f"_key{i}") for i, c in enumerate(keys)]
    same = [F.col(c).eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(keys)]
    every = sketches.select(*keys).distinct()
    for i, condition in enumerate(same):
        joined = condition if i == 0 else joined & condition
    right = found.select(*names, "sketch")
    return every.join(right, joined, "left").select(*keys, F.coalesce("sketch", F.array().cast("array<bigint>")).alias("sketch"))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of |A and B| / |A or B|: the share of the union's sketch that both hold. Two empty
    sets: 1; an empty one and another: 0."""
    both = merged(a, b, k)
    return F.when(F.size(both) == 0, 1.0).otherwise(F.size(F.array_intersect(both, F.array_intersect(a, b))) / F.size(both))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimate of a set's size: exact below ``k``, else (k - 1) over the k-th hash's share of all."""
    share = F.element_at(a, -1).cast("double") / 2.0**64 + 0.5
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of |A and B| / |A|, at most 1. An empty A: 1."""
    common = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def printed(a: Column) -> Column:
    """A sketch as a string: 16 hexadecimal digits a hash."""
    return F.lower(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def following(rows: DataFrame, by: list[str]) -> DataFrame:
    """The rows with ``next``, the row that follows in ascending order of the columns ``by``, which
    tell rows apart; after the last comes the first. Rows are ordered by range partitions; what
    follows a partition's last row is found from one row a partition."""
    whole = F.struct(*by, *[c for c in rows.columns if c not in by])
    dealt = cut(rows.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()))
    firsts = dealt.groupBy("_part").agg(F.min(whole).alias("first"))
    over = Window.orderBy("_part")
    after = firsts.select("_part", F.coalesce(F.lead("first").over(over), F.min("first").over(Window.partitionBy())).alias("after"))
    inside = dealt.withColumn("next", F.lead(whole).over(Window.partitionBy("_part").orderBy(*by)))
    return inside.join(after, "_part").select(*rows.columns, F.coalesce("next", "after").alias("next"))


def with_next(docs: DataFrame, computed: Callable[[DataFrame], DataFrame], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, value (that ``computed`` adds to rows with a text), next_text and next_value: those of
    the next document in descending order of ids; after the last comes the first.

    Null texts count as empty. Null ids come last. Rows with the same id are ordered by the hash of
    their texts; rows that repeat id and text are one document, and all get its values. A single
    document is its own next. Empty table: no rows. Other columns are not read.

    Texts are shuffled once, to spans of ids; a span also gets a copy of the first document of the
    next span. Spans that repeated ids make large are split by id, and an id with very many texts
    by their hashes. Which document a span needs is found on ids and hashes alone.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ident = F.col(id_col).cast("long")
    rows = docs.select(ident.alias("doc_id"), F.bitwise_not(F.coalesce(ident, F.lit(-(2**63)))).alias("o"), text_key(text).alias("key"), text.alias("text"))

    narrow = cut(rows.groupBy("o", "key").agg(F.count(F.lit(1)).alias("times")))
    span = F.shiftright("o", SPAN_BITS)
    crowded = cut(narrow.groupBy(span.alias("span")).count().filter(F.col("count") > CROWDED).select("span", F.lit(True).alias("crowded")))
    hot = cut(narrow.groupBy("o").count().filter(F.col("count") > SLICE).select("o", F.ceil(F.col("count") / SLICE).alias("slices")))

    def placed(df: DataFrame) -> DataFrame:
        df = join_sized(join_sized(df.withColumn("span", span), crowded, "span", "left"), hot, "o", "left")
        own = F.when(F.col("crowded"), F.col("o").bitwiseAND(2**SPAN_BITS - 1)).otherwise(0)
        part = F.when(F.col("slices") > 1, F.floor((F.col("key") / 2.0**64 + 0.5) * F.col("slices"))).otherwise(0)
        return df.withColumn("place", F.struct("span", own.cast("long").alias("own"), part.cast("long").alias("slice"))).drop("span", "crowded", "slices")

    firsts = placed(narrow).groupBy("place").agg(F.min(F.struct("o", "key")).alias("first"))
    seams = following(firsts.select("place.*", "first"), ["span", "own", "slice"])
    wanted = cut(seams.select("next.first.o", "next.first.key", F.struct("span", "own", "slice").alias("also")))

    again = cut(narrow.filter("times > 1"))
    if not again.isEmpty():
        twice = join_sized(rows, again, ["o", "key"], "inner").dropDuplicates(["o", "key"])
        rows = join_sized(rows, again.drop("times"), ["o", "key"], "left_anti").withColumn("times", F.lit(1).cast("long")).unionByName(twice)
    else:
        rows = rows.withColumn("times", F.lit(1).cast("long"))

    known = join_sized(placed(rows), wanted, ["o", "key"], "left")
    here = F.struct("place.*", F.lit(False).alias("copy"))
    there = F.when(F.col("also").isNotNull(), F.struct("also.*", F.lit(True).alias("copy")))
    dealt = known.select("doc_id", "o", "key", "text", "times", F.explode(F.array_compact(F.array(here, there))).alias("at")).select("at.*", "doc_id", "o", "key", "text", "times").repartition("span", "own", "slice")
    order = Window.partitionBy("span", "own", "slice").orderBy("copy", "o", "key")
    out = computed(dealt).withColumns({"next_text": F.lead("text").over(order), "next_value": F.lead("value").over(order)}).filter("not copy")
    if not again.isEmpty():
        out = out.withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    return out.select("doc_id", "text", "value", "next_text", "next_value")


def edited_text(text: Column, following_text: Column) -> Column:
    """The text with the last half of its code points (rounded down) replaced by the first as many,
    or all, of another."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.left(text, F.length(text) - half), F.left(following_text, half))


def fingerprints(docs: DataFrame, *, size: int = SIZE, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, sketch, n_shingles (estimated) for every row. Null texts: as empty ones, an
    empty sketch. Repeated rows: a row each. Empty table: no rows."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.length(text).cast("long").alias("n_chars"), text.alias("_text"))
    return sketched(rows, "_text", "sketch", size, k).drop("_text").withColumn("n_shingles", distinct_shingles(F.col("sketch"), k))


def edited_fingerprints(docs: DataFrame, *, size: int = SIZE, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every
    row: the fingerprints of a text and of its edited text (``edited_text`` with the next document
    of ``with_next``), and their resemblance to each other and to the next document's.

    Rows as ``with_next`` says. Texts without words have the empty fingerprint: near 1 to each
    other, 0 to all others.
    """
    both = with_next(docs, lambda df: sketched(df, "text", "value", size, k), id_col=id_col, text_col=text_col)
    edited = both.select("doc_id", F.length("text").cast("long").alias("n_chars"), "value", "next_value", edited_text(F.col("text"), F.col("next_text")).alias("edited"))
    return sketched(edited, "edited", "edited_value", size, k).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("value")).alias("fingerprint"),
        printed(F.col("edited_value")).alias("edited_fingerprint"),
        resemblance(F.col("value"), F.col("edited_value"), k).alias("near_edited"),
        resemblance(F.col("value"), F.col("next_value"), k).alias("near_next"),
    )
