import re

from pyspark.sql import functions as F

from dayfacts.llm import queries
from dayfacts.llm import url_filter as U

RULES = queries.URL_RULES


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return lower, re.match(r"[^?#]*", rest[len(host) :])[0]


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [
    "http://Example.COM/en/x", "https://www.example.com/en/", "http://example.com/fr/", "http://notexample.com/en/", "http://a.b.net/es/1", "http://x.net/ES/1", "http://net/fr/9",
    "http://x.org/a?utm_source=1&b=2", "https://www.x.org:443/a/?b=2#f", "http://x.org/a?b=3", "ftp://x.org", "x.org/a", "", None, "http://", "://", "http://ÉA.com/", "http://x.com?q", "http://a.org/p://q", "http://x.org/a?b=2&utm_id=9",
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("rule", F.lit("mine"))
    got = {r.page_id: r for r in U.filter_urls(pages, pages.limit(0), RULES).collect()}
    for i, url in enumerate(URLS):
        host, path = split(url)
        name, verdict = rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, name, verdict or "allow"), url


def test_listed_urls_are_found_in_any_spelling(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(99, URLS[7]), (None, URLS[7])], "page_id long, url string")
    listed = spark.createDataFrame([("https://x.org/a?b=2",), ("https://x.org/a?b=2",), (None,), ("junk",)], "url string")
    for blocks in (16, 1):  # one key a block, then one block for all
        got = U.filter_urls(pages, listed, RULES, keys_per_block=blocks).filter("verdict = 'block' and rule is null").collect()
        assert sorted(str(r.page_id) for r in got) == sorted(map(str, (7, 8, 19, 99, None)))


def test_false_positives_of_the_filter_do_not_block(spark):
    many = spark.range(3000).select(F.concat(F.lit("http://l.org/"), "id").alias("url"))
    pages = spark.range(3000, 6000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://l.org/"), "id").alias("url")).unionByName(many.select(F.lit(1).cast("long").alias("page_id"), "url"))
    for options in ({"keys_per_block": 400}, {"broadcast_bytes": 0}):
        got = U.filter_urls(pages, many, RULES, **options)
        assert got.count() == 6000 and got.filter("verdict = 'block'").count() == 3000 == got.filter("page_id = 1 and verdict = 'block'").count()


def test_every_listed_key_passes_the_filter(spark):
    keys = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    bloom = U.blocked_bloom(keys, "k", 100)
    block, masks = U._slots(F.col("k"), 100)
    met = keys.withColumn("block", block).join(bloom, "block")
    for k, m in enumerate(masks):
        met = met.filter(F.col(f"w{k}").bitwiseAND(m) == m)
    assert met.count() == 5000 and bloom.count() <= 100


def test_no_python_runs(small):
    listed = small["pages"].select("url")
    plan = U.filter_urls(small["pages"], listed, RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert U.filter_urls(small["pages"].limit(0), listed, RULES).count() == 0
