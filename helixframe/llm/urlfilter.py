"""Exact URL membership by a cascade of Bloom filters, in DataFrame functions only.

The universe is every key that a URL of the corpus asks for: each domain suffix of its host together with each start of
its path that has the length of a listed path. Level 1 encodes the listed keys. Level 2 encodes the universe's
keys that pass level 1 without being listed, level 3 the listed keys that pass level 2, and so on, until a level lets
nothing wrong through. A key of the universe is listed exactly if the number of levels that it passes before its first
miss is odd. So each URL is judged from the filters alone: they come as scalar subqueries, and no join touches the pages.

Level 1 is sized for about as many false positives as there are listed keys. All levels together then take about
1.5 * log2(universe / listed) + 9 bits for each listed key; this, not the corpus, decides what executors hold. A level is
put together in segments of bounded size, on as many tasks, and may take MOST_FILTER_BYTES at most. Longer lists are dealt to shards by the
hash of the key; each shard has cascades of its own, over its own part of the universe, and the pages are judged shard after shard.

What decides a URL is its longest listed key. Null URLs and those without `://` have an empty host and path and no rule.
Repeated and tied rows are judged one by one; an empty list allows everything, an empty table gives no rows; further columns do no
harm, and those named like a result give way to it. A URL of any length is read whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil, log, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import A_TO_Z, A_TO_Z_LOWER, materialise, read_table

#: Host, path and verdict of the rules.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Hash functions of the levels after the first, which sets their rate of false positives to one in eight.
LATER_HASHES = 3
#: Words of 64 bits in a segment of a filter, and bytes of a filter at most.
SEGMENT_WORDS, MOST_FILTER_BYTES = 1 << 13, 64 << 20


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null and for a URL without `://`."""
    tail = F.when(F.contains(url, F.lit("://")), url.substr(F.length(F.substring_index(url, "://", 1)) + 4, F.length(url)))
    host = F.regexp_extract(tail, r"^[^/?#]*", 0)
    path = F.regexp_extract(tail.substr(F.length(host) + 1, F.length(url)), r"^[^?#]*", 0)
    return F.coalesce(F.translate(host, A_TO_Z, A_TO_Z_LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def candidates(host: Column, path: Column, lengths: list[int], most_labels: int) -> Column:
    """(length, host length, key) of each key that a rule for the URL can have. A host has no slash, a path begins with one.

    No suffix has more labels than the listed hosts, so that a host of many labels costs no more than its length.
    """
    counts = F.sequence(F.lit(1), F.least(F.size(F.split(host, r"\.")), F.lit(most_labels)))
    suffixes = F.transform(counts, lambda i: F.call_function("substring_index", host, F.lit("."), -i))
    sizes = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length(path))

    def with_paths(suffix):
        return F.transform(sizes, lambda n: F.struct((F.length(suffix) + n).alias("length"), F.length(suffix).alias("of_host"), F.concat(suffix, path.substr(F.lit(1), n)).alias("key")))

    return F.flatten(F.transform(suffixes, with_paths))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: a table of one row with its segments of words of 64 bits, and how keys map to bits."""

    words: DataFrame
    bits: int
    hashes: int
    seed: int

    def positions(self, key: Column) -> list[Column]:
        """Bits of a key, from the two halves of one 64-bit hash."""
        h = F.xxhash64(key, F.lit(self.seed))
        low, high = h.bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
        return [F.pmod(low + F.lit(i) * high, F.lit(self.bits)) for i in range(self.hashes)]

    def passes(self, key: Column, words: Column) -> Column:
        """Whether all bits of the key are set in the words."""
        def is_set(p):
            at = F.shiftright(p, 6)
            word = F.get(F.get(words, F.floor(at / SEGMENT_WORDS).cast("int")), (at % SEGMENT_WORDS).cast("int"))
            return F.getbit(word, p.bitwiseAND(F.lit(63)).cast("int")) == 1

        return reduce(lambda a, b: a & b, map(is_set, self.positions(key)))


def build_level(keys: DataFrame, count: int, hashes: int, seed: int) -> Level:
    bits = 64 * ceil(max(64, count * hashes / log(2)) / 64)
    if bits > 8 * MOST_FILTER_BYTES:
        raise ValueError(f"a filter of {count} keys takes {bits // 8} bytes; {MOST_FILTER_BYTES} are allowed")
    level = Level(keys, bits, hashes, seed)
    set_bits = keys.select(F.explode(F.array(*level.positions(F.col("key")))).alias("p"))
    filled = set_bits.groupBy(F.shiftright("p", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("word"))
    dense = filled.unionByName(keys.sparkSession.range(bits // 64).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("word"))).groupBy("at").agg(F.bit_or("word").alias("word"))
    in_order = lambda c, by, x: F.transform(F.array_sort(F.collect_list(F.struct(by, x))), lambda p: p[x]).alias(c)
    segments = dense.groupBy(F.floor(F.col("at") / SEGMENT_WORDS).alias("segment")).agg(in_order("words", "at", "word"))
    return Level(materialise(segments.agg(in_order("words", "segment", "words")), "bloom-level"), bits, hashes, seed)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def attach(self, df: DataFrame, prefix: str) -> DataFrame:
        """Makes the filters available under names of this prefix; the optimiser puts them where they are read."""
        return df.withColumns({f"{prefix}{i}": x.words.select("words").scalar() for i, x in enumerate(self.levels)})

    def contains(self, key: Column, prefix: str) -> Column:
        """Whether a key of the universe is listed."""
        verdict = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels) - 1, -1, -1):
            verdict = F.when(~self.levels[i].passes(key, F.col(f"{prefix}{i}")), F.lit(i % 2 == 1)).otherwise(verdict)
        return verdict


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The levels for a table of listed keys over the universe (both: one column `key`; repeats and nulls are ignored)."""
    rows = listed.select("key", F.lit(True).alias("listed")).unionByName(universe.select("key", F.lit(False).alias("listed"))).where("key is not null")
    keys = materialise(rows.groupBy("key").agg(F.max("listed").alias("listed")), "bloom-keys")
    encode, test = keys.where("listed").select("key"), keys.where("not listed").select("key")
    sizes = {r["listed"]: r["count"] for r in keys.groupBy("listed").count().collect()}
    count, others = sizes.get(True, 0), sizes.get(False, 0)
    hashes = min(30, max(1, ceil(log2(max(2.0, others / max(1, count))))))
    levels: list[Level] = []
    while count:
        level = build_level(encode, count, hashes, len(levels) + 1)
        levels.append(level)
        wrong = materialise(test.withColumn("__words", level.words.select("words").scalar()).where(level.passes(F.col("key"), F.col("__words"))).select("key"), "bloom-wrong")
        encode, test, count, hashes = wrong, encode, wrong.count(), LATER_HASHES
    return Cascade(tuple(levels))


def shards_for(listed: int, others: int) -> int:
    """Into how many shards by hash keys have to be dealt, so that each one's first level stays well below MOST_FILTER_BYTES."""
    hashes = min(30, max(1, ceil(log2(max(2.0, others / max(1, listed))))))
    return max(1, ceil(listed * max(hashes, LATER_HASHES) / log(2) / 8 / (MOST_FILTER_BYTES / 2)))


def _decided(block: Cascade, allow: Cascade):
    """What the cascades say of a candidate."""

    def decided(c):
        blocked = block.contains(c["key"], "__block")
        return F.struct(c["length"].cast("int").alias("length"), c["of_host"].cast("int").alias("of_host"), c["key"].alias("key"), F.when(blocked, F.lit("block")).when(allow.contains(c["key"], "__allow"), F.lit("allow")).alias("verdict"))

    return decided


def judge(pages: DataFrame, rules: DataFrame, lengths: list[int], url_col: str = "url") -> DataFrame:
    """Adds host, path, rule and verdict. rules: (host, path, verdict); lengths: the lengths that their paths have."""
    host, path = split_url(F.col(url_col))
    labels = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    keys = candidates(F.col("__host"), F.col("__path"), lengths, max(1, labels))
    split = pages.withColumns({"__host": host, "__path": path})
    universe = split.select(F.explode(keys).alias("c")).select("c.key").distinct()
    listed = rules.select(F.concat("host", "path").alias("key"), "verdict")
    count = listed.count()
    # Most lists are small enough for one shard whatever the universe is.
    shards = 1 if shards_for(count, 1 << 62) == 1 else shards_for(count, universe.count())
    ready = split.withColumn("__best", F.lit(None).cast("struct<length:int,of_host:int,key:string,verdict:string>"))
    for shard in range(shards):
        mine = lambda key: F.pmod(F.xxhash64(key, F.lit(0)), F.lit(shards)) == shard if shards > 1 else F.lit(True)  # noqa: B023, E731
        own, asked = listed.where(mine(F.col("key"))), universe.where(mine(F.col("key")))
        block = build_cascade(own.where("verdict = 'block'").select("key"), asked)
        allow = build_cascade(own.where("verdict = 'allow'").select("key"), asked)

        of_shard = F.filter(keys, lambda c: mine(c["key"])) if shards > 1 else keys
        best = F.array_max(F.filter(F.transform(of_shard, _decided(block, allow)), lambda d: d["verdict"].isNotNull()))
        attached = allow.attach(block.attach(ready, "__block"), "__allow")
        found = F.array_max(F.array("__best", best)) if shards > 1 else best
        ready = attached.select(*[F.col(c) for c in pages.columns], "__host", "__path", found.alias("__best"))
        if shards > 1:  # one shard's filters at a time
            ready = materialise(ready, "bloom-judged")
    chosen = ready.withColumns({"host": F.col("__host"), "path": F.col("__path"), "__rule": F.col("__best.key"), "__verdict": F.coalesce("__best.verdict", F.lit("allow"))})
    return chosen.select(*[c for c in pages.columns if c not in ("host", "path", "rule", "verdict")], "host", "path", F.col("__rule").alias("rule"), F.col("__verdict").alias("verdict"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.sql("select * from values " + ", ".join(map(str, RULES)) + " as rules(host, path, verdict)")
    return judge(pages, rules, sorted({len(path) for _, path, _ in RULES})).select("page_id", "host", "path", "rule", "verdict")


ORACLE = f"""
WITH tails AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS tail FROM pages
), hosts AS (
  SELECT page_id, tail, coalesce(regexp_extract(tail, '^[^/?#]*'), '') AS raw_host FROM tails
), parts AS (
  SELECT page_id, translate(raw_host, '{A_TO_Z}', '{A_TO_Z_LOWER}') AS host,
         coalesce(regexp_extract(substr(tail, length(raw_host) + 1), '^[^?#]*'), '') AS path FROM hosts
), ruled AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""

QUERIES = {"op10_url_filters": op10_url_filters}
ORACLES = {"op10_url_filters": ORACLE}
