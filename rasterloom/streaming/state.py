"""Status updates and observations that arrive over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rasterloom.operators.tables import upserted


def follow_status(updates: DataFrame, keys: list[str], seq: str, log: str, checkpoint: str) -> StreamingQuery:
    """Append each micro-batch to the log below ``log``, in a folder of its own, so that a batch that is run again replaces itself."""

    def append(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch={number}")

    return updates.select(*updates.columns).writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_status(spark: SparkSession, log: str, keys: list[str], seq: str) -> DataFrame:
    """The state that the log amounts to."""
    return upserted(spark.read.parquet(log).drop("batch"), keys, seq)


def daily_sums(obs: DataFrame, late: str = "2 days", factor: float = 0.5) -> DataFrame:
    """``pixel, day, total`` over a stream of ``(pixel, ts, value)``; a day is closed once it is ``late`` behind."""
    by = obs.withWatermark("ts", late).groupBy("pixel", F.window("ts", "1 day"))
    return by.agg((F.sum("value") * factor).alias("total")).select("pixel", F.col("window.start").cast("date").alias("day"), "total")


def new_events(catalogue: DataFrame, seen_late: str = "30 days") -> DataFrame:
    """Events of a stream with ``folder_name, ts``, each once."""
    return catalogue.withWatermark("ts", seen_late).dropDuplicatesWithinWatermark(["folder_name"])
