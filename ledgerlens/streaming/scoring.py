"""Structured Streaming twins of the row-wise operators.

The rule engine, final decision stage (given the benchmark scores on the
row), cost engine and guardrails are stateless projections, so the very same
functions run on ``readStream`` frames. Stateful pieces use Spark's own state
stores: watermarked windowed counts for velocity, and a keyed latest-value
aggregation for case status.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.cost import score_requests
from ledgerlens.operators.rules import apply_rules
from ledgerlens.session import ensure_checkpoint_dir


def scoring_stream(transactions: DataFrame) -> DataFrame:
    """Rules applied to a (streaming or batch) transaction frame."""
    return apply_rules(transactions)


def request_scoring_stream(requests: DataFrame) -> DataFrame:
    """Cost-sensitive scoring of a (streaming or batch) request frame."""
    return score_requests(requests)


def velocity_stream(events: DataFrame, ts: str = "ts", key: str = "user_id", duration: str = "2 minutes",
                    slide: str = "1 minute", watermark: str = "10 minutes") -> DataFrame:
    """Sliding-window event counts per key with a watermark (late rows
    beyond the watermark are dropped; state is expired by it).
    ``withWatermark`` needs TIMESTAMP, so NTZ inputs are cast first."""
    e = events.withColumn("_ets", F.col(ts).cast("timestamp")).withWatermark("_ets", watermark)
    g = e.groupBy(F.window("_ets", duration, slide).alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "n")


def latest_status_stream(status_events: DataFrame) -> DataFrame:
    """Latest status per case from a stream of status updates (keyed
    state in the aggregation state store; use update output mode)."""
    return (status_events.groupBy("case_id")
            .agg(F.max_by(F.struct("status", "updated_at"), F.struct("updated_at", "status")).alias("_e"))
            .select("case_id", "_e.status", "_e.updated_at"))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``
    (read from the session; a scratch folder is set only when it is unset)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def run_available_now(stream: DataFrame, sink_path: str, checkpoint: str, output_mode: str = "append",
                      fmt: str = "parquet") -> None:
    """Drain everything currently available into a table, then stop."""
    q = (stream.writeStream.format(fmt).outputMode(output_mode)
         .option("checkpointLocation", checkpoint).option("path", sink_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def run_state_table(stream: DataFrame, table_path: str, checkpoint: str, key: str) -> DataFrame:
    """Drain a keyed stateful aggregation into a table of changes: every micro-batch
    writes the keys it changed into a folder of its own (written again, not twice, if
    the batch is retried), and the returned table is each key's latest change. No
    batch rewrites what earlier ones wrote."""
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(table_path, f"batch={batch_id}"))

    q = (stream.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    rest = [c for c in stream.columns if c != key]
    changes = spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])).parquet(table_path)
    return (changes.groupBy(key).agg(F.max_by(F.struct(*rest), F.col("batch")).alias("_e"))
            .select(*[F.col(c) if c == key else F.col(f"_e.{c}").alias(c) for c in stream.columns]))


def open_windows(spark: SparkSession, checkpoint: str, key: str) -> DataFrame:
    """The windows that a drained ``velocity_stream`` still holds in its state (those the
    watermark has not closed), read with Spark's state data source."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(F.col("key.window.start").alias("window_start"), F.col("key.window.end").alias("window_end"),
                        F.col("key")[key].alias(key), F.col("value.count").alias("n"))
