"""Streaming forms: counts in windows with a watermark, sessions, and incremental enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tumbling_counts(events: DataFrame, time: str, length: str, by: list[str], late: str | None = None) -> DataFrame:
    """window_start, by, n. With ``late`` the result is final once the watermark passes; works on streams and tables alike."""
    rows = events.withWatermark(time, late) if late else events
    return rows.groupBy(F.window(time, length).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")


def sessions(events: DataFrame, time: str, gap: str, by: list[str], late: str | None = None) -> DataFrame:
    rows = events.withWatermark(time, late) if late else events
    out = rows.groupBy(F.session_window(time, gap).alias("w"), *by).agg(F.count("*").alias("n"), F.min(time).alias("first_ts"), F.max(time).alias("last_ts"))
    return out.select(*by, "first_ts", "last_ts", "n")


def sliding_counts(events: DataFrame, time: str, length: str, step: str, by: list[str], late: str | None = None) -> DataFrame:
    """As tumbling_counts, with windows that start every ``step`` and overlap."""
    rows = events.withWatermark(time, late) if late else events
    return rows.groupBy(F.window(time, length, step).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")


def enrich_stream(events: DataFrame, answer, path: str, checkpoint: str):
    """Micro-batches of new rows answered and written, each to a partition ``batch_id`` of its own: a batch that is tried again replaces itself.

    Files already answered are not read again. Back-pressure is the reader's: maxFilesPerTrigger bounds a batch.
    """

    def put(batch: DataFrame, number: int) -> None:
        answer(batch).write.mode("overwrite").parquet(f"{path}/batch_id={number}")

    return events.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def progress(query) -> dict[str, float]:
    """Rows read, rows a second and the batch's number, of a stream's last micro-batch."""
    last = query.lastProgress or {}
    return {"batch": last.get("batchId", -1), "rows": last.get("numInputRows", 0), "rows_per_second": last.get("processedRowsPerSecond", 0.0)}


def alarm(done: DataFrame, by: list[str], failed: Column, least: int, most_share: float) -> DataFrame:
    """Health of a run: groups of at least ``least`` rows of which more than ``most_share`` failed."""
    n = done.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(failed).alias("n_failed"))
    return n.where((F.col("n") >= least) & (F.col("n_failed") > most_share * F.col("n")))
