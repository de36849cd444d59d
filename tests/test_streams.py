"""End marks of producers: late, missing, overtaken and wrong ones."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from helixframe.operators.scratch import scratch_path
from helixframe.streaming import routes

START = dt.datetime(2024, 1, 1)
EVENT = "consumer string, producer string, announced long, at timestamp"


def feed(spark, *files):
    """A stream that delivers each list of (consumer, producer, announced, hour) in a micro-batch of its own, in this order."""
    path = scratch_path(spark, "events")
    for rows in files:
        frame = spark.createDataFrame([(c, p, n, START + dt.timedelta(hours=h)) for c, p, n, h in rows], EVENT)
        frame.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(path)


def ended(spark, *files):
    rows = routes.await_producers(feed(spark, *files), ["p", "q"]).collect()
    return sorted(tuple(r) for r in rows)


def test_a_consumer_ends_with_its_last_producer(spark):
    got = ended(
        spark,
        [("a", "p", None, 0), ("a", "p", None, 0), ("a", "p", 2, 0), ("a", "q", 1, 0), ("b", "q", None, 0)],  # a mark before its row
        [("b", "p", 0, 0.1), ("b", "q", 1, 0.1)],
        [("a", "q", None, 0.2)],  # the late row
    )
    assert got == [("a", "p", 2, True), ("a", "q", 1, True), ("b", "p", 0, True), ("b", "q", 1, True)]


def test_a_missing_producer_is_told_by_time(spark):
    got = ended(
        spark,
        [("a", "p", None, 0), ("a", "p", 1, 0), ("a", "q", None, 0)],  # q never ends
        [("b", "p", 0, 3), ("b", "q", None, 3)],
        [("b", "q", 1, 3.5)],
        [("a", "q", 1, 4)],  # a has ended: let go
    )
    assert got == [("a", "p", 1, True), ("a", "q", 1, False), ("b", "p", 0, True), ("b", "q", 1, True)]


def test_a_consumer_that_waits_at_the_end_has_no_rows(spark):
    assert ended(spark, [("a", "p", None, 0), ("a", "p", 1, 0)]) == []


@pytest.mark.parametrize("rows", [[("a", "x", None, 0)], [("a", "p", 1, 0), ("a", "p", 2, 0)], [("a", "p", 0, 0), ("a", "p", None, 0)]])
def test_wrong_events_are_errors(spark, rows):
    with pytest.raises(StreamingQueryException):
        ended(spark, rows)


def test_marks_count_rows_of_every_pair(spark):
    rows = spark.createDataFrame([(1, 1, START), (1, 1, START), (2, 2, START)], "c int, m int, at timestamp")
    marks = routes.with_end_marks(rows, "c", "m", "at").where("announced is not null").collect()
    assert sorted((r["consumer"], r["producer"], r["announced"]) for r in marks) == [("1", "1", 2), ("1", "2", 0), ("2", "1", 0), ("2", "2", 1)]


def test_files_of_a_feed_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(routes, "FILE_ROWS", 10, raising=False)
    rows = routes.as_stream(spark.range(100).select("id", F.input_file_name().alias("file")))
    path, batches = scratch_path(spark, "fed"), []
    rows.select("id", F.input_file_name().alias("file")).writeStream.foreachBatch(lambda df, n: (batches.append(n), df.write.mode("append").parquet(path))[0]).option("checkpointLocation", scratch_path(spark, "fed-state")).trigger(availableNow=True).start().awaitTermination()
    most = spark.read.parquet(path).groupBy("file").count().agg(F.max("count"), F.sum("count")).first()
    assert most[0] <= 12 and most[1] == 100 and len(batches) == 4  # files of 25 rows before
