"""Line-first cleaning: rules judge each line, failing lines go, and a document that loses too much text is rejected.

Lines are what `\\n` separates. A line without a word always stays. The rules, by what can be counted in a line and in the corpus:

* boilerplate: a line that stands in many different places of the corpus, a place being the two lines around it. Copies of a
  text put their lines in the same places over and over, and so don't make them boilerplate;
* symbols: too many characters of `#*$%&|<>` for its words;
* navigation: separators between most words, or a short line without a sentence's end beside another such line;
* punctuation: a short line without a sentence's end by itself, or doubled exclamation or question marks that abound;
* capitals: a longer line in capitals.

A document is kept if it passes the base measures (at least 10 words, at most a fifth of them in repeated 5-word windows)
and loses at most half of its word characters. Null text counts as empty. Whole texts are read, however long; the windows are compared
exactly, by ranking, never by a hash that could collide. Repeated rows are judged one by one, ids aren't looked at, and an empty table
gives no rows. Further columns stay; one that has the result's name is replaced.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from helixframe.llm.common import give_back, materialise, read_table, slices, small_batches, word_codes

WINDOW, LEAST_WORDS, MOST_REPEATED_PERCENT, MOST_LOST = 5, 10, 20, 0.5
SHORT_LINE, SEPARATORS_PER_WORD, SYMBOLS_PER_WORD, SHOUTS_PER_WORD = 6, 0.2, 0.3, 0.2
SPACES, SYMBOLS, SEPARATORS = " \t\n\x0b\x0c\r", "#*$%&|<>", "|›»•"
#: Punctuation, by its Unicode category, that doesn't end a sentence.
_OPEN = frozenset("#*%&@/\\,-›»•")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Places that make a line boilerplate: a share of the documents, but at least so many.
COMMON_SHARE, LEAST_PLACES = 1e-3, 12

MEASURES = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars")]
    + [T.StructField("failed_lines", T.MapType(T.StringType(), T.LongType())), T.StructField("cleaned", T.StringType())]
)


def common_lines(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The sorted hashes of the boilerplate lines of a table.

    A line's places are counted in all documents: distinct places first, so that a frequent line is spread by its places. Documents
    have no more places than lines, so that fewer lines reach the share than 1 / COMMON_SHARE times the lines of a document on average,
    however many documents there are.
    """
    lines = F.filter(F.split(F.col(text_col), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    hashes = docs.select(F.transform(lines, lambda x: F.xxhash64(F.btrim(x, F.lit(SPACES)))).alias("h")).where(F.size("h") > 0)
    none = F.array(F.lit(0).cast("long"))
    around = F.arrays_zip(F.concat(none, "h").alias("a"), F.col("h").alias("line"), F.concat(F.slice("h", 2, F.size("h")), none).alias("b"))
    placed = hashes.select(F.explode(F.slice(around, 1, F.size("h"))).alias("x"))
    places = placed.select(F.col("x.line"), F.xxhash64("x.a", "x.b").alias("place")).distinct().groupBy("line").agg(F.count("*").alias("places"))
    found = materialise(places.where(F.col("places") >= LEAST_PLACES), "quality-lines")
    least = max(LEAST_PLACES, COMMON_SHARE * docs.count())
    rows = found.where(F.col("places") >= least).select("line").toArrow()
    return np.sort(rows.column("line").to_numpy())


def ends_sentence(line: str) -> bool:
    last = line.rstrip(SPACES)[-1]
    return last not in _OPEN and unicodedata.category(last) in ("Po", "Pe", "Pf")


def fails(line: str) -> str | None:
    """The rule that a line with words fails by itself, or None; `open` for a short line without a sentence's end."""
    n = len(_WORD.findall(line))
    if sum(map(line.count, SYMBOLS)) > SYMBOLS_PER_WORD * n + 1:
        return "navigation" if sum(map(line.count, SEPARATORS)) > SEPARATORS_PER_WORD * n else "symbols"
    if sum(map(line.count, "›»•")) > max(2, SEPARATORS_PER_WORD * n):
        return "navigation"
    if line.count("!!") + line.count("??") > SHOUTS_PER_WORD * n + 1:
        return "punctuation"
    if n <= SHORT_LINE:
        return None if ends_sentence(line) else "open"
    return "capitals" if line.isupper() else None


def clean_lines(text: str, is_common: Callable[[str], bool] = lambda line: False) -> tuple[str, int, int, dict[str, int]]:
    """The text without failing lines, the word characters that went with them, repeated lines, failures by rule."""
    lines, verdicts, repeated = text.split("\n"), {}, 0
    full = [i for i, line in enumerate(lines) if line.strip(SPACES)]
    for i in full:
        if lines[i] in verdicts:
            repeated += 1
        else:
            verdicts[lines[i]] = "boilerplate" if is_common(lines[i]) else fails(lines[i])
    lost, rules, gone = 0, {}, set()
    for k, i in enumerate(full):
        rule = verdicts[lines[i]]
        if rule == "open":
            beside = full[max(0, k - 1) : k] + full[k + 1 : k + 2]
            rule = "navigation" if any(verdicts[lines[j]] == "open" for j in beside) else "punctuation"
        if rule:
            gone.add(i)
            lost += len(lines[i]) - sum(map(lines[i].count, SPACES))
            rules[rule] = rules.get(rule, 0) + 1
    return "\n".join(line for i, line in enumerate(lines) if i not in gone), lost, repeated, rules


def _ranks(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1]


def repeated_words(codes: np.ndarray, counts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each text the number of its words that lie in a window found twice or more in it. window: 5."""
    assert window == 5
    text = np.repeat(np.arange(len(counts)), counts)
    out = np.zeros(len(counts), np.int64)
    n = len(codes) - window + 1
    if n <= 0:
        return out
    base = int(codes.max()) + 1
    pairs = _ranks((text[:-1] * base + codes[:-1]) * base + codes[1:]) if len(counts) * base * base < 1 << 62 else _ranks(_ranks(text[:-1] * base + codes[:-1]) * base + codes[1:])
    fours = _ranks(pairs[: len(pairs) - 2] * len(codes) + pairs[2:])
    fives = fours[:n] * base + codes[window - 1 :]
    whole = text[:n] == text[window - 1 :]
    _, inverse, times = np.unique(fives[whole], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(whole)[times[inverse] > 1]
    marks = np.zeros(len(codes) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + window, -1)
    covered = np.cumsum(marks)[:-1] > 0
    np.add.at(out, text[covered], 1)
    return out


def measured(texts: pa.Array, is_common: Callable[[str], bool] = lambda line: False) -> list[tuple]:
    codes, counts, _ = word_codes(texts)
    repeats = repeated_words(codes, counts)
    out = []
    for text, n, r in zip(texts.to_pylist(), counts.tolist(), repeats.tolist()):
        text = text or ""
        cleaned, lost, repeated, rules = clean_lines(text, is_common)
        out.append((n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), repeated, r, lost, rules, cleaned))
    return out


def line_measures(common: np.ndarray, spark: SparkSession):
    """A column function of the measures of a text, given the boilerplate lines' hashes."""
    held = spark.sparkContext.broadcast(common)  # bounded as in common_lines()

    @pandas_udf(MEASURES)
    def apply(texts: pd.Series) -> pd.DataFrame:
        listed = held.value

        def is_common(line: str) -> bool:
            h = xxhash.xxh64_intdigest(line.strip(SPACES), 42)
            h -= h >> 63 << 64
            at = listed.searchsorted(h)
            return at < len(listed) and listed[at] == h

        batch = pa.record_batch([pa.array(texts, pa.large_string(), from_pandas=True)], ["text"])
        rows = [row for piece in slices(batch, "text") for row in measured(piece.column(0), is_common if len(listed) else lambda line: False)]
        give_back()
        return pd.DataFrame(rows, columns=MEASURES.names)

    return apply


def judge_quality(docs: DataFrame, text_col: str = "text", out_col: str = "quality", common: np.ndarray | None = None) -> DataFrame:
    """Adds a struct: the measures, the cleaned text, base_failed and kept. common: common_lines() of these or other documents."""
    small_batches(docs.sparkSession)
    measure = line_measures(common_lines(docs, text_col) if common is None else common, docs.sparkSession)

    def verdict(m):
        failed = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED_PERCENT * m["n_words"])
        kept = ~failed & (m["lost_chars"] <= MOST_LOST * m["word_chars"])
        return F.struct(*[m[c].alias(c) for c in MEASURES.names], failed.alias("base_failed"), kept.alias("kept"))

    return docs.withColumn(out_col, F.get(F.transform(F.array(measure(F.col(text_col))), verdict), 0))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_quality(docs).select("doc_id", *[f"quality.{c}" for c in (*MEASURES.names[:5], "base_failed", "kept", "lost_chars")])


QUERIES = {"op5_quality": op5_quality}
ORACLES: dict[str, str] = {}
