"""The per-user funnel flags maintained incrementally with Structured Streaming.

Same conditional aggregate as the batch mart (max of step flags, min of step times
per user), applied to a stream of raw events; the state store keeps one row per user.
Every micro-batch can be merged into a table with ``foreachBatch``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.funnel import funnel_flags
from ..operators.staging import stg_events
from ..schemas import RAW_EVENTS, STEPS


def read_event_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema=RAW_EVENTS,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def streaming_funnel_flags(raw_events_stream: DataFrame, steps: Sequence[str] = STEPS) -> DataFrame:
    """Streaming DataFrame of per-user flags and first times (update / complete mode)."""
    return funnel_flags(stg_events(raw_events_stream), steps)


def start_flags_query(flags: DataFrame, checkpoint: str, sink, output_mode: str = "update", trigger_once=True):
    """Start the query; ``sink(batch_df, batch_id)`` receives each micro-batch of changed users."""
    w = flags.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
