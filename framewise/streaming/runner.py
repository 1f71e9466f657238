"""Starting streaming queries."""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from framewise.settings import rocksdb_state, run_dir


def start(writer: DataStreamWriter, df: DataFrame) -> StreamingQuery:
    """Start ``writer``, made from ``df``, with the state store that keyed state needs."""
    with rocksdb_state(df.sparkSession):
        return writer.start()


def run_until_quiet(query: StreamingQuery, silence_ms: int, stall_s: float = 900, poll_s: float = 0.5) -> None:
    """Wait until ``query`` has taken in all that its sources hold and its timers of ``silence_ms`` have passed, then stop it.

    There is no limit to how long that takes. A query that fails or ends by itself before is an error, as is one that has had
    no micro-batch for ``stall_s`` seconds.
    """
    quiet, batch, since = None, None, time.monotonic()
    try:
        while not query.awaitTermination(poll_s):
            progress = query.lastProgress
            if progress is None or progress.batchId == batch:
                if time.monotonic() - since > stall_s:
                    raise TimeoutError(f"no micro-batch for {stall_s} seconds, after batch {batch}")
                continue
            batch, since = progress.batchId, time.monotonic()
            if progress.numInputRows or any(s.startOffset != s.endOffset for s in progress.sources):
                quiet = None
                continue
            began = datetime.fromisoformat(progress.timestamp).timestamp() * 1000
            quiet = began if quiet is None else quiet
            # Timers were set when the last rows came, which was before the first batch without any.
            if began - quiet >= silence_ms:
                return
    finally:
        query.stop()
    raise RuntimeError("the query ended before its input was through")


def drain(df: DataFrame, name: str) -> DataFrame:
    """Run ``df`` over all input that is there now and return its appended rows as a table.

    Rows and checkpoint go to a new folder below the shared one.
    """
    folder = run_dir(df.sparkSession, name)
    writer = df.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    writer = writer.option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/checkpoint")
    start(writer, df).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/rows")


def drain_observed(df: DataFrame, name: str, metric: str) -> tuple[DataFrame, dict[str, int]]:
    """``drain``, and the sums of the observed metric ``metric`` over all micro-batches."""
    folder = run_dir(df.sparkSession, name)
    writer = df.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    query = start(writer.option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/checkpoint"), df)
    query.awaitTermination()
    totals: dict[str, int] = {}
    for progress in query.recentProgress:
        for part, value in progress.observedMetrics[metric].asDict().items() if metric in progress.observedMetrics else ():
            totals[part] = totals.get(part, 0) + value
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/rows"), totals


def drain_updates(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """The same for a result whose rows are replaced over time: the latest row per ``keys``.

    Each micro-batch writes its changed rows to a folder of its own.
    """
    folder = run_dir(df.sparkSession, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        changed = batch.withColumn("batch_id", F.lit(batch_id))
        changed.write.mode("overwrite").parquet(f"{folder}/rows/part={batch_id}")

    writer = df.writeStream.foreachBatch(write).outputMode("update").trigger(availableNow=True)
    start(writer.option("checkpointLocation", f"{folder}/checkpoint"), df).awaitTermination()
    schema = T.StructType([*df.schema.fields, T.StructField("batch_id", T.IntegerType())])
    written = df.sparkSession.read.schema(schema).parquet(f"{folder}/rows")
    others = [c for c in df.columns if c not in keys]
    latest = [F.max_by(c, "batch_id").alias(c) for c in others]
    return written.groupBy(*keys).agg(*latest).select(*df.columns)
