"""Event counting, critical-escalation routing and cleaning as Structured Streaming jobs.

The transformations are plain ``DataFrame -> DataFrame`` functions, so the same code serves a
Kafka topic, played-back files and a batch read.
"""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from spendlens.plans import events as batch


def is_critical() -> Column:
    return (F.col("event_type") == "escalation_raised") & (F.col("payload")["severity"] == "Critical")


def critical_escalations(events: DataFrame) -> DataFrame:
    """Raised escalations of severity Critical, for the second sink."""
    return events.where(is_critical())


def stamp_produced(events: DataFrame) -> DataFrame:
    """Add the time at which an event is handed to the stream."""
    return events.withColumn("produced_at", F.current_timestamp())


def running_counts(events: DataFrame) -> DataFrame:
    """Per event type: messages, critical escalations, first and last production time.

    One row per type is all the state a summary of the stream needs.
    """
    produced = F.col("produced_at") if "produced_at" in events.columns else F.lit(None).cast("timestamp")
    return events.groupBy(F.coalesce("event_type", F.lit("unknown")).alias("event_type")).agg(
        F.count("*").alias("event_count"),
        F.count_if(is_critical()).alias("critical_count"),
        F.min(produced).alias("first_produced_at"),
        F.max(produced).alias("last_produced_at"),
    )


def summarise(counts: DataFrame, topic: str) -> DataFrame:
    """One row: totals, counts per type, forwarded escalations and messages per second.

    The rate is taken over the span of production times and is null when there is no span.
    """
    seconds = (F.unix_micros(F.max("last_produced_at")) - F.unix_micros(F.min("first_produced_at"))) / 1e6
    total = F.sum("event_count")
    return counts.agg(
        F.current_timestamp().alias("run_at"),
        F.lit(topic).alias("topic"),
        F.coalesce(total, F.lit(0)).alias("total_messages_consumed"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("event_type", "event_count")))).alias("event_counts"),
        F.coalesce(F.sum("critical_count"), F.lit(0)).alias("critical_escalations_forwarded"),
        F.round(F.when(seconds > 0, total / seconds), 2).alias("throughput_messages_per_second"),
    )


def clean_stream(events: DataFrame) -> DataFrame:
    """Streaming form of the event cleaning: every id passes once, however late its first row comes.

    No watermark drops rows; the ids seen are kept in the state store on disk, one small row each. Of several
    copies the first to arrive passes, while the batch form keeps the earliest by time.
    """
    return batch.with_time_parts(batch.with_ids(events).dropDuplicates(["event_id"]))


def start_counts(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the running counts as a table at ``path``; a repeated batch overwrites itself."""
    def save(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.coalesce(1).write.mode("overwrite").parquet(path)

    return (
        running_counts(events).writeStream.outputMode("complete").foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def start_summary(events: DataFrame, topic: str, path: str, checkpoint: str) -> StreamingQuery:
    """Keep a one-row JSON summary of the whole stream at ``path``."""
    def save(batch_df: DataFrame, batch_id: int) -> None:
        summarise(batch_df, topic).write.mode("overwrite").json(path)

    return (
        running_counts(events).writeStream.outputMode("complete").foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def start_file_sink(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to a Parquet table; the sink log makes each batch count once."""
    return (
        rows.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def start_kafka_sink(rows: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Forward events to a topic as JSON keyed by event type; needs the Kafka connector."""
    message = rows.select(
        F.col("event_type").alias("key"), F.to_json(F.struct(*rows.columns)).alias("value")
    )
    return (
        message.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("topic", topic).option("checkpointLocation", checkpoint).start()
    )
