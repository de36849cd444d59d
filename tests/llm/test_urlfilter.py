import random

import duckdb
import pytest

from helixframe.llm import urlfilter

URLS = [
    "https://www.example.com/en/1?x=/en/", "http://example.com/en/", "https://blog.Example.COM/en/a#b", "https://example.com/de/en/", "https://a.net/es/1", "https://net/fr/", "https://notnet/fr/1", "https://x.org",
    "https://com/", "https://com", "https://a.com?/en/", "no scheme", "", None, "a://b://c.com/fr/", "://example.com/en/x", "https://a..com/x", "https://u@www.example.com:80/en/", "HTTP://WWW.EXAMPLE.COM/en/é", "https://www.example.com/EN/", "https://b.net/fr\n/", "x://a\nb.net/es/",
]


def test_query_equals_sql(spark, tmp_path):
    rows = [(i, u, "h", "mine") for i, u in enumerate(URLS)] + [(None, URLS[0], None, None), (3, URLS[3], None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string, rule string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(map(tuple, urlfilter.op10_url_filters(spark, str(tmp_path)).collect()), key=str)
    db = duckdb.connect()
    db.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    assert got == sorted(db.sql(urlfilter.ORACLE).fetchall(), key=str)
    by_id = {r[0]: r for r in got}
    assert by_id[0][1:] == ("www.example.com", "/en/1", "www.example.com/en/", "allow") and by_id[2][3:] == ("example.com/en/", "block") and by_id[11][1:] == ("", "", None, "allow")


def test_cascade_is_exact_over_the_universe(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "SEGMENT_WORDS", 16)
    rng = random.Random(2)
    universe = [f"h{rng.randrange(10**6)}.example/{i}" for i in range(6000)]
    listed = set(universe[:500]) | {"elsewhere/"}
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys], "key string")
    cascade = urlfilter.build_cascade(frame([*listed, *universe[:9], None]), frame([*universe, universe[7], None]))
    assert len(cascade.levels) > 1
    held = cascade.attach(frame(universe), "w").where(cascade.contains(urlfilter.F.col("key"), "w")).collect()
    assert {r["key"] for r in held} == listed & set(universe)
    empty = urlfilter.build_cascade(frame([]), frame(universe))
    assert empty.attach(frame(universe), "w").where(empty.contains(urlfilter.F.col("key"), "w")).count() == 0


def test_empty_pages(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    assert urlfilter.op10_url_filters(spark, str(tmp_path)).count() == 0


def test_a_list_beyond_one_filter_is_judged_in_shards(spark, monkeypatch):
    rng = random.Random(4)
    hosts = sorted({f"{rng.choice('abcdef')}{i}.example" for i in range(300)})
    listed = [(h, "/", "block" if i % 3 else "allow") for i, h in enumerate(hosts)] + [(f"x.{h}", "/en/", "allow") for h in hosts[:100]]
    urls = [f"https://{rng.choice(['', 'x.', 'y.x.', 'z.'])}{rng.choice([*hosts, 'other.example'])}/{rng.choice(['', 'en/', 'en', 'de/'])}" for _ in range(900)]
    monkeypatch.setattr(urlfilter, "MOST_FILTER_BYTES", 256)
    assert urlfilter.shards_for(len(listed), len(urls)) >= 2

    def plain(url):
        host, path = url[8:].split("/", 1)
        best = max(((len(h + p), len(h), h + p, v) for h, p, v in listed if (host == h or host.endswith("." + h)) and ("/" + path).startswith(p)), default=None)
        return (url, best and best[2], best[3] if best else "allow")

    pages = spark.createDataFrame([(i, u, "kept") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = urlfilter.judge(pages, spark.createDataFrame(listed, "host string, path string, verdict string"), [1, 4])
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    assert sorted((r["url"], r["rule"], r["verdict"]) for r in got.collect()) == sorted(map(plain, urls))


def test_one_filter_never_passes_its_bound(spark, monkeypatch):
    keys = spark.createDataFrame([(f"h{i}/",) for i in range(900)], "key string")
    monkeypatch.setattr(urlfilter, "MOST_FILTER_BYTES", 64)
    with pytest.raises(ValueError, match="900 keys"):
        urlfilter.build_cascade(keys, keys)


def test_long_urls_are_read_whole(spark):
    pages = spark.createDataFrame([(1, "https://" + "a." * 100_000 + "net/es/" + "x/" * 200_000)], "page_id long, url string")
    rules = spark.createDataFrame([("net", "/es/", "block"), ("b.net", "/es/", "allow")], "host string, path string, verdict string")
    row = urlfilter.judge(pages, rules, [4]).first()
    assert row["verdict"] == "block" and row["rule"] == "net/es/" and len(row["path"]) == 400_004 and len(row["host"]) == 200_003
