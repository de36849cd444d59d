"""Structured Streaming forms of the alignment flow. Each consumes what is there (availableNow) and equals its batch twin.

State: routing and sorting keep none; the mate join is bounded by a watermark on the time of arrival; counts keep a row a bin,
end marks two numbers for each consumer and producer.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from helixframe.operators.genome import coordinate_sort, with_bin
from helixframe.operators.scratch import scratch_path as scratch


#: Rows of a file of a feed.
FILE_ROWS = 1 << 18


def as_stream(rows: DataFrame, batches: int = 4) -> DataFrame:
    """A table written as files of bounded size, whose number grows with the table, and read as a stream of them in so many batches."""
    path = scratch(rows.sparkSession, "feed")
    at_once = -(-rows.count() // (batches * FILE_ROWS)) or 1
    rows.repartition(batches * at_once).write.parquet(path)
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", at_once).parquet(path)


def _run(writer, spark: SparkSession, name: str) -> None:
    query = writer.option("checkpointLocation", scratch(spark, f"{name}-state")).trigger(availableNow=True).start()
    query.awaitTermination()


def route_to_bins(alignments: DataFrame, bins: DataFrame) -> DataFrame:
    """Alignments with a key as they arrive, written by bin; bins are a static table."""
    spark, path = bins.sparkSession, scratch(bins.sparkSession, "routed")
    _run(with_bin(alignments, bins).writeStream.format("parquet").partitionBy("bin").option("path", path), spark, "routed")
    return spark.read.parquet(path).withColumn("bin", F.col("bin").cast("int"))


def with_end_marks(rows: DataFrame, consumer: str, producer: str, at: str) -> DataFrame:
    """(consumer, producer, announced, at): the rows, announced null, and for each consumer an end mark of every producer.

    A mark says how many rows the producer has sent there, none included, so that marks may overtake rows. Names are text.
    """
    sent = rows.select(F.col(consumer).cast("string").alias("consumer"), F.col(producer).cast("string").alias("producer"), F.col(at).alias("at"))
    names = sent.agg(F.sort_array(F.collect_set("producer")).alias("p")).select("p").scalar()
    per = sent.groupBy("consumer", "producer").agg(F.count("*").alias("announced"))
    every = sent.groupBy("consumer").agg(F.max("at").alias("at")).withColumn("producer", F.explode(names))
    marks = every.join(per, ["consumer", "producer"], "left").select("consumer", "producer", F.coalesce("announced", F.lit(0)).alias("announced"), "at")
    return sent.select("consumer", "producer", F.lit(None).cast("long").alias("announced"), "at").unionByName(marks)


ENDED = "consumer string, producer string, rows long, ended boolean"


def await_producers(events: DataFrame, producers: list[str], patience_s: int = 3600) -> DataFrame:
    """(consumer, producer, rows, ended) of each consumer, once: when the end marks of all producers and the rows they announce have come,
    or when events patience_s seconds younger than the consumer's last one have come; ended then tells which producers are complete.

    events: the stream of with_end_marks(). A consumer's state is two numbers a producer and stays as long as the query does, so that what
    comes after its end is let go. A consumer that waits when the input ends has no rows. An unknown producer, two marks of one
    producer that differ, and more rows than announced are errors. Events of the feed may be out of order by patience_s seconds; what
    is older than that is dropped by the watermark, and its consumer ends by time.
    """
    at = {name: i for i, name in enumerate(producers)}

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        received, announced, closed = state.get if state.exists else ([0] * len(at), [-1] * len(at), False)
        received, announced, last = list(received), list(announced), 0
        if closed:
            for _ in frames:
                pass
            return
        if not state.hasTimedOut:
            for frame in frames:
                if unknown := set(frame["producer"]) - set(at):
                    raise ValueError(f"unknown producers: {sorted(map(str, unknown))}")
                is_mark = frame["announced"].notna()
                for name, n in frame["producer"][~is_mark].value_counts().items():
                    received[at[name]] += int(n)
                for name, n in zip(frame["producer"][is_mark], frame["announced"][is_mark]):
                    if announced[at[name]] not in (-1, int(n)):
                        raise ValueError(f"producer {name} has ended twice")
                    announced[at[name]] = int(n)
                last = max(last, int(frame["at"].max().timestamp() * 1000))
        ended = [r == a for r, a in zip(received, announced)]
        if any(-1 < a < r for r, a in zip(received, announced)):
            raise ValueError(f"consumer {key[0]} has got more rows than were announced")
        closed = all(ended) or state.hasTimedOut
        state.update((received, announced, closed))
        if closed:
            yield pd.DataFrame({"consumer": key[0], "producer": producers, "rows": received, "ended": ended})
        else:
            state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + 1)

    spark, path = events.sparkSession, scratch(events.sparkSession, "ended")
    done = events.withWatermark("at", f"{patience_s} seconds").groupBy("consumer").applyInPandasWithState(
        step, ENDED, "received array<long>, announced array<long>, closed boolean", "append", GroupStateTimeout.EventTimeTimeout
    )
    _run(done.writeStream.format("parquet").option("path", path), spark, "ended")
    return spark.read.schema(ENDED).parquet(path)


def join_mates(first: DataFrame, second: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Mates of two feeds (sample, ordinal, seq, arrived), as they meet; what is later than the delay is let go."""
    a = first.select("sample", "ordinal", F.col("seq").alias("seq1"), F.col("arrived").alias("at1")).withWatermark("at1", delay)
    b = second.select(F.col("sample").alias("s2"), F.col("ordinal").alias("o2"), F.col("seq").alias("seq2"), F.col("arrived").alias("at2")).withWatermark("at2", delay)
    near = F.expr(f"sample = s2 and ordinal = o2 and at2 between at1 - interval {delay} and at1 + interval {delay}")
    spark, path = first.sparkSession, scratch(first.sparkSession, "mates")
    _run(a.join(b, near).select("sample", "ordinal", "seq1", "seq2").writeStream.format("parquet").option("path", path), spark, "mates")
    return spark.read.parquet(path)


def sort_bins(alignments: DataFrame, bins: DataFrame) -> DataFrame:
    """Bins are written as micro-batches arrive and sorted once the input has ended; then they follow each other."""
    spark, path = bins.sparkSession, scratch(bins.sparkSession, "binned")

    def add(batch: DataFrame, number: int) -> None:
        with_bin(batch, bins).write.mode("overwrite").partitionBy("bin").parquet(f"{path}/batch={number}")

    _run(alignments.writeStream.foreachBatch(add), spark, "binned")
    return coordinate_sort(spark.read.parquet(path).withColumn("bin", F.col("bin").cast("int")).drop("batch"))


def running_counts(alignments: DataFrame, bins: DataFrame) -> DataFrame:
    """(bin, n): a streaming aggregate in update mode; the last value of each bin is its total."""
    spark, path = bins.sparkSession, scratch(bins.sparkSession, "counts")

    def add(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(path)

    counted = with_bin(alignments, bins).groupBy("bin").agg(F.count("*").alias("n"))
    _run(counted.writeStream.outputMode("update").foreachBatch(add), spark, "counts")
    return spark.read.parquet(path).groupBy("bin").agg(F.max_by("n", "batch").alias("n"))
