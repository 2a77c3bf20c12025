"""Tables that change by whole batches, with progress kept beside them.

A batch writes its rows into a folder named by the batch and then a commit record, by one rename. Readers follow the
records alone: while a batch is written they see the last whole version of every table, and what a lost driver left
behind is never seen. A batch that comes again finds its record and changes nothing. All tables of a batch share one record.
"""

import json
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from spendlens.operators import dedup
from spendlens.plans import events as batch
from spendlens.streaming import event_stream


class _Folder:
    """Small files of a folder that every node can reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.path, name)

    def names(self) -> list[str]:
        if not self.fs.exists(self.path):
            return []
        found = (status.getPath().getName() for status in self.fs.listStatus(self.path))
        return sorted(name for name in found if not name.startswith((".", "_")))

    def has(self, name: str) -> bool:
        return self.fs.exists(self._at(name))

    def put(self, name: str, text: str) -> None:
        """Whole or not at all; a file that is there already stays."""
        hidden = self._at(f".{name}")
        out = self.fs.create(hidden, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self.fs.rename(hidden, self._at(name)):
            self.fs.delete(hidden, False)

    def get(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


class CommittedTables:
    """Named tables under ``path``, written batch by batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.records = _Folder(spark, f"{path}/commits")

    @staticmethod
    def _name(batch_id: int) -> str:
        return f"{batch_id:020d}"

    def batches(self) -> list[int]:
        return [int(name) for name in self.records.names()]

    def has(self, batch_id: int) -> bool:
        return self.records.has(self._name(batch_id))

    def commit(self, batch_id: int, tables: Mapping[str, DataFrame]) -> bool:
        """Write the tables of a batch; False if it was committed before."""
        if self.has(batch_id):
            return False
        for name, rows in tables.items():
            rows.write.mode("overwrite").parquet(self.folder(name, batch_id))
        self.records.put(self._name(batch_id), json.dumps({"batch": batch_id, "tables": {name: rows.schema.json() for name, rows in tables.items()}}))
        return True

    def folder(self, name: str, batch_id: int) -> str:
        return f"{self.path}/{name}/batch-{batch_id:020d}"

    def _schema(self, name: str, batch_id: int) -> T.StructType:
        return T.StructType.fromJson(json.loads(json.loads(self.records.get(self._name(batch_id)))["tables"][name]))

    def latest(self, name: str) -> DataFrame | None:
        """The table as the last committed batch wrote it."""
        known = self.batches()
        return self.spark.read.schema(self._schema(name, known[-1])).parquet(self.folder(name, known[-1])) if known else None

    def all_batches(self, name: str) -> DataFrame | None:
        """What all committed batches wrote, together."""
        known = self.batches()
        if not known:
            return None
        return self.spark.read.schema(self._schema(name, known[-1])).parquet(*[self.folder(name, n) for n in known])


def add_counts(before: DataFrame | None, more: DataFrame) -> DataFrame:
    """Counts per event type of two sets of events as those of both."""
    if before is None:
        return more
    return before.unionByName(more).groupBy("event_type").agg(
        F.sum("event_count").alias("event_count"), F.sum("critical_count").alias("critical_count"),
        F.min("first_produced_at").alias("first_produced_at"), F.max("last_produced_at").alias("last_produced_at"),
    )


def start_router(events: DataFrame, path: str, checkpoint: str, topic: str) -> StreamingQuery:
    """Counts so far, their summary and the critical escalations of each batch, all in one commit."""
    tables = CommittedTables(events.sparkSession, path)

    def save(rows: DataFrame, batch_id: int) -> None:
        if tables.has(batch_id):
            return
        counts = add_counts(tables.latest("counts"), event_stream.running_counts(rows)).coalesce(1)
        tables.commit(batch_id, {
            "counts": counts, "summary": event_stream.summarise(counts, topic),
            "critical": event_stream.critical_escalations(rows),
        })

    return (
        events.writeStream.queryName(f"router {path}").foreachBatch(save).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


KEEP_MS = 7 * 24 * 3600 * 1000
BUCKETS = 1 << 15
_STATE = "ids array<string>, firsts array<bigint>, copies array<array<bigint>>, seen array<bigint>"


def earliest_copies(events: DataFrame, keep_ms: int = KEEP_MS, buckets: int = BUCKETS) -> DataFrame:
    """Events that may be the first of their id: new ids, and copies dated no later than any seen before.

    For each id its state holds the earliest time sent and which rows were sent with it; it is given up ``keep_ms`` after the id was last
    seen. Ids share a state by a hash, as one call for every id costs far more than its rows; ``buckets`` is to be chosen for
    the number of ids that come within ``keep_ms``. A copy that comes even later passes again, and is settled against the table when that is read (:func:`corrected`), so none is lost.
    """
    rows = batch.with_ids(events)
    kept = rows.withColumns({
        "_time": F.coalesce(F.unix_micros("timestamp"), F.lit(-(1 << 62))),
        "_row": F.xxhash64(*[F.to_json(F.array_sort(F.map_entries(c.name))) if isinstance(c.dataType, T.MapType) else F.col(c.name)
                             for c in rows.schema.fields]),
        "_bucket": F.pmod(F.xxhash64("event_id"), F.lit(buckets)),
        "payload": F.to_json("payload"),
    })
    columns = [c for c in kept.columns if c not in ("_time", "_row", "_bucket")]
    schema = T.StructType([kept.schema[c] for c in columns])

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = {i: (first, copies, seen) for i, first, copies, seen in zip(*state.get)} if state.exists else {}
        if not state.hasTimedOut:
            now = state.getCurrentProcessingTimeMs()
            for frame in frames:
                chosen = []
                for place, (i, time, row) in enumerate(zip(frame["event_id"].tolist(), frame["_time"].tolist(), frame["_row"].tolist())):
                    first, copies, _ = known.get(i, (None, [], now))
                    if first is None or time < first:
                        first, copies = time, []
                    if time == first and row not in copies:
                        copies = [*copies, row]
                        chosen.append(place)
                    known[i] = first, copies, now
                if chosen:
                    yield frame.iloc[chosen][columns]
        over = state.getCurrentWatermarkMs() - keep_ms
        left = [(i, *entry) for i, entry in known.items() if entry[2] > over]
        if not left:
            state.remove()
            return
        state.update(tuple(list(column) for column in zip(*left)))
        state.setTimeoutTimestamp(min(entry[3] for entry in left) + keep_ms)

    # the watermark is that of arrival: it ends states, and no row is ever late for it
    arrived = kept.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", "0 seconds")
    sent = arrived.groupBy("_bucket").applyInPandasWithState(run, schema, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return sent.withColumn("payload", F.from_json("payload", "map<string,string>"))


def start_corrected(events: DataFrame, path: str, checkpoint: str, keep_ms: int = KEEP_MS) -> StreamingQuery:
    """Append the possible first copies of each batch to the committed table ``events``."""
    tables = CommittedTables(events.sparkSession, path)

    def save(rows: DataFrame, batch_id: int) -> None:
        tables.commit(batch_id, {"events": rows})

    return (
        earliest_copies(events, keep_ms).writeStream.outputMode("append").foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def corrected(spark: SparkSession, path: str) -> DataFrame:
    """The cleaned events: of all copies sent, the one that the batch cleaning keeps, in whatever order they came."""
    sent = CommittedTables(spark, path).all_batches("events")
    return batch.with_time_parts(dedup.keep_first(sent, ["event_id"], ["timestamp"]))


_PROGRESS = "query string, batch_id bigint, rows bigint, started string, start_offset string, end_offset string"


class ProgressTable(StreamingQueryListener):
    """Batches of streaming queries with their rows and offsets, one file per query and batch.

    A query keeps its id over restarts, so a batch that runs again after a failure is reported once. Triggers that
    find nothing new report no batch.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.folder = _Folder(spark, path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        offsets = [json.dumps([getattr(source, side) for source in progress.sources]) for side in ("startOffset", "endOffset")]
        if offsets[0] == offsets[1]:
            return
        values = [str(progress.id), progress.batchId, progress.numInputRows, progress.timestamp, *offsets]
        self.folder.put(f"{progress.id}-{progress.batchId:020d}.json", json.dumps(dict(zip((c.split()[0] for c in _PROGRESS.split(", ")), values))))

    def read(self) -> DataFrame:
        return self.spark.read.schema(_PROGRESS).json(self.path)
