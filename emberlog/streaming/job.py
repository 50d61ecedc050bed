"""The detection job: events and the control log in, tagged events and metrics out."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery, StreamingQueryListener

from ..config import Settings
from ..functions.keys import bucket_count, key_for
from ..operators.match import tag_events
from ..operators.output import emitted, metrics_messages
from ..sources import kafka
from .control import Snapshot, snapshot

log = logging.getLogger(__name__)
Writer = Callable[[DataFrame, int], None]


class Counters(StreamingQueryListener):
    """Running totals over the batches of a query: windows, events in, last rates."""

    def __init__(self):
        self.windows, self.events, self.last = 0, 0, {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        if p.numInputRows:
            self.windows += 1
            self.events += p.numInputRows
            self.last = {"input_per_s": round(p.inputRowsPerSecond or 0, 2), "processed_per_s": round(p.processedRowsPerSecond or 0, 2), "batch_ms": p.batchDuration}

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def tag_batch(events: DataFrame, state: Snapshot, settings: Settings) -> DataFrame | None:
    """The tagged events of one window of events(value, ...), or None where it is skipped: no rules, and matched events alone wanted."""
    if not state.rules and settings.output_mode == "matched_only":
        return None
    return tag_events(events, state.rules, state.filters, state.mapping, state.parser)


def outputs(tagged: DataFrame, state: Snapshot, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(output, metrics messages) of a window's tagged events."""
    keys = ["k"] if "k" in tagged.columns else []
    output = emitted(tagged, state.rules, settings.output_mode, settings.keep_filtered_events, state.custom_fields, settings.apply_parser_to_output_events)
    return output, metrics_messages(tagged, settings.job_id, by=keys)


def process_batch(events: DataFrame, state: Snapshot, settings: Settings) -> tuple[DataFrame, DataFrame] | None:
    """Both in one go; who writes both should keep the tagged events in between."""
    tagged = tag_batch(events, state, settings)
    return None if tagged is None else outputs(tagged, state, settings)


def keyed(events: DataFrame, settings: Settings) -> DataFrame:
    """Events with their key k. Matching is row by row, so keys cause no shuffle; only metrics group by them."""
    buckets = bucket_count(settings.parallelism, settings.key_groups_per_task, settings.autoscaler_enabled, settings.autoscaler_max_parallelism)
    return events.withColumn("k", key_for(settings.keying_strategy, F.col("value"), buckets))


def build_stream(events: DataFrame, control: Callable[[], DataFrame], settings: Settings, write: Writer, write_metrics: Writer | None = None, trigger: dict | None = None) -> StreamingQuery:
    """One query; each micro-batch is a window, read with the control log's state at its start.

    `control` gives the log as a batch table (value, seq). The batch is tagged once for both outputs:
    its tagged events are kept (memory and disk, dropped after); a lost executor's part of them is made anew.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        state = snapshot(control(), settings.job_id)
        for rule, why in state.errors.items():
            log.warning("rule %s left out: %s", rule, why)
        tagged = tag_batch(keyed(batch, settings), state, settings)
        if tagged is None:
            return
        tagged = tagged.persist()
        try:
            output, metrics = outputs(tagged, state, settings)
            write(output, batch_id)
            if write_metrics is not None:
                write_metrics(metrics.select("value"), batch_id)
        finally:
            tagged.unpersist()

    writer = events.select(F.col("value").cast("string").alias("value")).writeStream.foreachBatch(run).option("checkpointLocation", settings.checkpoint_path)
    return writer.trigger(**(trigger or {"processingTime": f"{settings.window_size_seconds} seconds"})).start()


def union_topics(spark: SparkSession, settings: Settings, read: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """All input topics in one table (value, topic): one subscription with Kafka, else the union of what `read` gives."""
    if read is None:
        reader: DataStreamReader = spark.readStream.format("kafka").options(**kafka.source_options(settings, settings.input_topics))
        return reader.load().selectExpr("CAST(value AS string) AS value", "topic")
    parts = [read(t).select("value").withColumn("topic", F.lit(t)) for t in settings.input_topics]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_job(spark: SparkSession, settings: Settings) -> StreamingQuery:
    """Kafka in and out, by the settings."""

    def control() -> DataFrame:
        rows = spark.read.format("kafka").options(**kafka.source_options(settings, [settings.rules_topic], "earliest", batch=True)).load()
        # one sequence over partitions: a key's messages share a partition, where offsets rise
        return rows.selectExpr("CAST(value AS string) AS value", "offset AS seq")

    def to(topic: str) -> Writer:
        return lambda df, _: df.write.format("kafka").options(**kafka.sink_options(settings, topic)).save()

    return build_stream(union_topics(spark, settings), control, settings, to(settings.output_topic), to(settings.metrics_topic) if settings.metrics_topic else None)
