"""URL filters: host and path rules, then a list of canonical URLs behind a blocked Bloom filter.

The filter is a table of 256-bit blocks, four words each, with two bits of a key set in every
word. It passes possible hits only to the exact join on the whole canonical URL. All of it is
DataFrame work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SMALL_ROWS, ascii_lower, cut

WORDS = 4
#: Bytes of a block in a broadcast table, with its key and overhead.
BLOCK_BYTES = 120


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` or a default port, path without trailing slashes, and the query
    without ``utm_`` parameters; scheme and fragment go. Null and what has no ``://``: empty."""
    host = F.regexp_replace(F.regexp_replace(url_host(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(url_path(url), r"/+$", "")
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, r"(^|&)utm_[^&]*", ""), r"^&+", "")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest of (verdict, host, path) rules that fits: its host or a subdomain of it, its
    path a prefix. A struct of rule and verdict, null where none fits; ties go to the first."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    table = F.array(*[F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in ordered])
    fits = F.filter(table, lambda r: ((host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"]))) & path.startswith(r["path"]))
    return F.get(fits, F.lit(0))


def _slots(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a key, and the mask of its two bits in each word of the block."""
    masks = []
    for k in range(WORDS):
        h = F.xxhash64(key, F.lit(k + 1))
        first, second = h.bitwiseAND(F.lit(63)).cast("int"), F.shiftright(h, 32).bitwiseAND(F.lit(63)).cast("int")
        masks.append(F.call_function("shiftleft", F.lit(1).cast("long"), first).bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), second)))
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(blocks)), masks


def blocked_bloom(keys: DataFrame, key_col: str, blocks: int) -> DataFrame:
    """block, w0..w3: the non-empty blocks of the filter over a column of keys."""
    block, masks = _slots(F.col(key_col), blocks)
    bits = keys.select(block.alias("block"), *[m.alias(f"w{k}") for k, m in enumerate(masks)])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{k}").alias(f"w{k}") for k in range(WORDS)])


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], *, id_col: str = "page_id", url_col: str = "url", listed_col: str = "url", keys_per_block: int = 16, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """page_id, host, path, canonical, rule, verdict for every page: the longest fitting rule's
    verdict, else block if the canonical URL is listed, else allow.

    The Bloom filter is broadcast if its blocks fit ``broadcast_bytes`` by the list's count, and
    joined by block otherwise. Pages that a rule decides, and those that the filter rejects, skip
    the exact join: in the same pass over the pages if the list, counted, is small enough to be
    broadcast, else in a branch of their own, so that only possible hits are shuffled.

    Null URLs and URLs without ``://``: empty host, path and canonical URL; never listed. Null
    ids and repeated rows: a row each. Null or repeated listed URLs: as if absent or once. Empty
    list: rules alone. Empty table: no rows. Other columns are not read, whatever their names.
    """
    listed = cut(listed.select(canonical_url(F.col(listed_col)).alias("listed")).filter(F.col("listed") != "").distinct())
    n_listed = listed.count()
    blocks = max(1, -(-n_listed // keys_per_block))
    bloom = blocked_bloom(listed, "listed", blocks)
    if blocks * BLOCK_BYTES <= broadcast_bytes:
        bloom = F.broadcast(bloom)

    url = F.col(url_col).cast("string")
    judged = pages.select(F.col(id_col).alias("page_id"), F.coalesce(url_host(url), F.lit("")).alias("host"), F.coalesce(url_path(url), F.lit("")).alias("path"), F.coalesce(canonical_url(url), F.lit("")).alias("canonical"))
    judged = judged.withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules))
    block, masks = _slots(F.col("canonical"), blocks)
    probed = judged.withColumn("block", block).join(bloom, "block", "left")
    hit = F.col("fit").isNull() & (F.col("canonical") != "")
    for k, mask in enumerate(masks):
        hit = hit & (F.coalesce(F.col(f"w{k}"), F.lit(0)).bitwiseAND(mask) == mask)
    probed = probed.select("page_id", "host", "path", "canonical", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("ruled"), hit.alias("possible"))

    def verdict(df: DataFrame, found: Column) -> DataFrame:
        return df.select("page_id", "host", "path", "canonical", "rule", F.coalesce("ruled", F.when(found, "block").otherwise("allow")).alias("verdict"))

    if n_listed <= SMALL_ROWS and broadcast_bytes:
        met = probed.join(F.broadcast(listed), F.col("possible") & (F.col("canonical") == F.col("listed")), "left")
        return verdict(met, F.col("listed").isNotNull())
    possible = probed.filter("possible").join(listed, F.col("canonical") == F.col("listed"), "left")
    return verdict(probed.filter("not possible"), F.lit(False)).unionByName(verdict(possible, F.col("listed").isNotNull()))
