"""Importance resampling towards a target distribution.

Texts are lower-cased in A-Z and cut into words by an untrained pre-tokeniser of the tokenizers library, a Split by an expression
that returns words with their offsets. Windows over neighbouring offsets are the features: all runs of 1 to `longest` words, joined by
one space. A feature's bucket is the crc32 of its UTF-8 bytes. Each document becomes its buckets and their counts, so that texts are
tokenised once and a row is bounded by the number of buckets. Histograms of raw and target texts are added up on executors; they
give each bucket a gain, the logarithm of its smoothed share in the target over that in the raw texts, and a document's weight is the sum of its
features' gains. Scores are weights plus Gumbel noise that is drawn from the id; the highest scores are the sample, without replacement.

The draw orders narrow rows by range partitions and numbers them; nothing is ordered in one task. Gains go to the tasks as one
array of as many numbers as there are buckets.

Null text has no features. Whole texts are read, a megabyte at a time, cut where no word is; only a run of more letters than
that is a piece of its own. A null id draws like an empty text for an id and comes after others of its score. Rows that repeat an id each count and may each be drawn; of equal
rows any one is first. Empty tables give no rows; with an empty target all gains come from the smoothing. Further columns are ignored whatever
their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from helixframe.llm.common import give_back, materialise, read_table, slices, small_batches, whole_texts
from helixframe.operators.matrix import numbered_rows

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NO_WORD = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
LONGEST, BUCKETS, LEAST_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, 2024
#: Code points that the pre-tokeniser gets at once.
PIECE = 1 << 20

FEATURES = "doc_id long, n_words long, n_features long, buckets array<int>, counts array<long>"


def pieces(text: str, most: int = PIECE) -> Iterator[str]:
    """The text in pieces of about `most` code points that begin outside words."""
    at = 0
    while len(text) - at > most:
        cut = _NO_WORD.search(text, at + most)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def words_of(text: str, splitter: pre_tokenizers.PreTokenizer, most: int = PIECE) -> Iterator[list[tuple[str, tuple[int, int]]]]:
    """Lists of the words with their offsets, a list a piece."""
    for piece in pieces(text, most):
        yield splitter.pre_tokenize_str(piece)


def runs(found: list[str], before: list[str], longest: int) -> Iterator[str]:
    """All runs of 1 to `longest` words that end in `found`; before: the words that come before it."""
    for size in range(1, longest + 1):
        if size == 1:
            yield from found
        else:
            line = before[max(0, len(before) - size + 1) :] + found
            yield from map(" ".join, zip(*(line[i:] for i in range(size))))


def bucket_counts(text: str, splitter: pre_tokenizers.PreTokenizer, known: dict[str, int], longest: int = LONGEST, buckets: int = BUCKETS, most: int = PIECE) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Words, features, the buckets that occur and how often. The text is in lower case; known: buckets of features seen before."""
    n_words = n_features = 0
    held, before, crc = np.zeros(buckets, np.int64), [], zlib.crc32
    for offsets in words_of(text, splitter, most):
        found = [word for word, _ in offsets]
        n_words += len(found)
        codes = []
        for feature in runs(found, before, longest):
            code = known.get(feature)
            if code is None:
                code = known[feature] = crc(feature.encode()) % buckets
            codes.append(code)
        n_features += len(codes)
        np.add.at(held, codes, 1) if len(codes) < buckets else np.add(held, np.bincount(codes, minlength=buckets), out=held)
        before = (before + found)[-(longest - 1) :] if longest > 1 else []
    used = np.flatnonzero(held)
    return n_words, n_features, used, held[used]


def features(docs: DataFrame, id: Column, text: Column, longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """The documents' buckets and counts (columns of FEATURES)."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)
        for batch in batches:
            for piece in slices(batch, "text"):
                known: dict[str, int] = {}  # no more than a piece's words
                lower = pc.ascii_lower(whole_texts(piece.column(1)))
                rows = [bucket_counts(x.as_py(), splitter, known, longest, buckets) for x in lower]
                sizes = np.cumsum([0, *(len(r[2]) for r in rows)])
                lists = lambda i, kind: pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate([r[i] for r in rows]).astype(kind)))  # noqa: B023, E731
                yield pa.record_batch([piece.column(0), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), lists(2, np.int32), lists(3, np.int64)], ["doc_id", "n_words", "n_features", "buckets", "counts"])
            give_back()

    return docs.select(id.cast("long").alias("doc_id"), text.alias("text")).mapInArrow(count, FEATURES)


def histogram(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all rows of features(); each task adds up its own rows first."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            np.add.at(held, batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy())
        used = np.flatnonzero(held)
        yield pa.record_batch([pa.array(used), pa.array(held[used])], ["bucket", "n"])

    return found.select("buckets", "counts").mapInArrow(add, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain in thousandths of a nat, from histograms of raw and target texts."""
    double = lambda x: F.coalesce(x, F.lit(0)).cast("double")
    sums = raw.select("bucket", F.col("n").alias("s"), F.lit(0).alias("t")).unionByName(target.select("bucket", F.lit(0).alias("s"), F.col("n").alias("t")))
    per_bucket = raw.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(sums.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "bucket", "left")
    kept = materialise(per_bucket.select("bucket", double(F.col("s")).alias("s"), double(F.col("t")).alias("t")), "resampling-buckets")
    all_s, all_t = kept.agg(F.sum("s"), F.sum("t")).first()
    ratio = (F.col("t") + 1) * F.lit(all_s + buckets) / ((F.col("s") + 1) * F.lit(all_t + buckets))
    rows = kept.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain")).toArrow()  # as many rows as buckets
    out = np.zeros(buckets, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("gain").to_numpy()
    return out


def weighted(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of features()."""
    held = found.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(held.value[lists.flatten().to_numpy()] * batch.column(4).flatten().to_numpy())])
            ends = np.cumsum(sizes)
            yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), pa.array(sums[ends] - sums[ends - sizes])], ["doc_id", "n_words", "n_features", "weight"])

    return found.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, drawn from the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): rank is the place in the draw, null for what isn't drawn."""
    found = materialise(features(docs, F.col(id_col), F.col(text_col), longest, buckets), "resampling-features")
    wanted = features(target, F.lit(0), F.col(target_col), longest, buckets)
    scored = weighted(found, gains(histogram(found, buckets), histogram(wanted, buckets), buckets)).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = materialise(scored, "resampling-scores")
    enters = F.col("n_words") >= least_words
    drawn = scored.where(enters).count() * percent // 100
    placed = numbered_rows(scored.where(enters), F.desc("score"), F.asc_nulls_last("doc_id"), out="place")
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = placed.select(*columns, F.when(F.col("place") < drawn, F.col("place") + 1).cast("long").alias("rank"))
    return ranked.unionByName(scored.where(~enters).select(*columns, F.lit(None).cast("long").alias("rank")))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_WORDS = "list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
ORACLE = f"""
WITH RECURSIVE bits AS (
  SELECT range AS n, 0 AS k, CAST(range AS UBIGINT) AS c FROM range(256)
  UNION ALL SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(CAST(3988292384 AS UBIGINT), c >> 1) ELSE c >> 1 END FROM bits WHERE k < 8
), steps AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
found AS (SELECT doc_id, {_WORDS} AS words FROM documents), wanted AS (SELECT {_WORDS} AS words FROM benchmark),
uses AS (SELECT w, sum(s) AS s, sum(t) AS t FROM (SELECT unnest(words) AS w, 1 AS s, 0 AS t FROM found UNION ALL SELECT unnest(words), 0, 1 FROM wanted) GROUP BY w),
coded AS (
  SELECT w, s, uses.t AS t, xor(CAST(4294967295 AS UBIGINT), list_reduce(list_prepend(CAST(4294967295 AS UBIGINT),
    list_transform(range(0, octet_length(encode(w))), lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i + 1, 2) AS UBIGINT))),
    lambda c, b: xor(c >> 8, steps.t[CAST(xor(c, b) & 255 AS BIGINT) + 1]))) % {BUCKETS} AS bucket
  FROM uses, steps
), totals AS (SELECT CAST(sum(s) AS DOUBLE) AS s, CAST(sum(t) AS DOUBLE) AS t FROM coded),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(sum(c.t) AS DOUBLE) + 1) * (any_value(a.s) + {BUCKETS}) / ((CAST(sum(c.s) AS DOUBLE) + 1) * (any_value(a.t) + {BUCKETS})))) AS BIGINT) AS g
  FROM coded c, totals a GROUP BY bucket
), word_gain AS (SELECT w, g FROM coded JOIN gain USING (bucket)),
weights AS (SELECT doc_id, sum(g) AS weight FROM (SELECT doc_id, unnest(words) AS w FROM found) JOIN word_gain USING (w) GROUP BY doc_id),
scored AS (
  SELECT f.doc_id, CAST(len(words) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) AS BIGINT) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || left(sha256('{SEED}:' || f.doc_id), 8) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM found f LEFT JOIN weights w ON w.doc_id = f.doc_id
), places AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= {LEAST_WORDS})
SELECT s.doc_id, n_features, weight, score, CAST(CASE WHEN place <= {PERCENT} * n // 100 THEN place END AS BIGINT) AS rank FROM scored s LEFT JOIN places p ON p.doc_id = s.doc_id
"""

QUERIES = {"op11_resampling": op11_resampling}
ORACLES = {"op11_resampling": ORACLE}
