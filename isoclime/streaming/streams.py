"""Streaming forms of landing, hourly aggregation and the silver upsert."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from isoclime.operators.cleaning import dedup_latest
from isoclime.sources.landing import new_rows


def read_folder(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def stream_land(events: DataFrame, keys: Sequence[str], ts: str, path: str, checkpoint: str, lateness: str = "1 day") -> StreamingQuery:
    """Land a file stream once per key: repeats within the watermark are dropped, state is bounded by it."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(keys))
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()


def hourly(events: DataFrame, ts: str = "ts", entity: str = "city_id", value: str = "value", lateness: str = "1 hour") -> DataFrame:
    """Mean, maximum and count per entity and hour; on a stream, hours are emitted once the watermark has passed them."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp"))
    rows = rows.withWatermark(ts, lateness) if events.isStreaming else rows
    out = rows.groupBy(F.window(ts, "1 hour").alias("_w"), entity).agg(F.avg(value).alias("mean_value"), F.max(value).alias("max_value"), F.count("*").alias("n"))
    return out.select(entity, F.col("_w.start").alias("hour"), "mean_value", "max_value", "n")


def stream_hourly(events: DataFrame, path: str, checkpoint: str, **options: str) -> StreamingQuery:
    writer = hourly(events, **options).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The Parquet table at a path, or an empty one if nothing was written yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def upsert_batch(df: DataFrame, number: int, keys: Sequence[str], values: Sequence[str], ts: str, newest: str, bronze: str, late: str, marks: str, max_late_days: int = 7) -> None:
    """One micro-batch of ``stream_upsert_silver``; run again with the same number it changes nothing.

    The newest stamp before a batch is written down with its number before any row is, so a replay splits its rows
    as the first run did, whichever of the two appends that one reached.
    """
    spark, kind = df.sparkSession, df.schema[ts].dataType
    schema = StructType().add("batch", "long").add("mark", kind).add("newest", kind)
    seen = _read(spark, marks, schema)
    mine = seen.filter(F.col("batch") == number).select("mark").first()
    if mine is None:
        mark, top = seen.filter(F.col("batch") < number).agg(F.max("newest")).first()[0], df.agg(F.max(ts)).first()[0]
        highest = max((x for x in (mark, top) if x is not None), default=None)
        spark.createDataFrame([(number, mark, highest)], schema).coalesce(1).write.mode("append").parquet(marks)
    else:
        mark = mine["mark"]
    limit = None if mark is None else F.lit(mark) - F.expr(f"INTERVAL '{max_late_days}' DAY")
    old = F.lit(False) if limit is None else F.coalesce(F.col(ts) < limit, F.lit(False))
    dated = df.withColumn("_day", F.to_date(ts))
    have = _read(spark, bronze, dated.schema)
    if limit is not None:
        have = have.filter((F.col("_day") >= F.to_date(limit)) | F.col("_day").isNull())  # days a fresh row can fall on
    same = list(dict.fromkeys([*values, newest, ts]))
    same = [c for c in same if c not in keys]
    new_rows(dated.filter(~old), have, keys, same).write.mode("append").partitionBy("_day").parquet(bronze)
    new_rows(df.filter(old), _read(spark, late, df.schema), keys, same).write.mode("append").parquet(late)


def stream_upsert_silver(
    rows: DataFrame, keys: Sequence[str], values: Sequence[str], ts: str, newest: str, bronze: str, late: str, checkpoint: str, max_late_days: int = 7
) -> StreamingQuery:
    """Append new versions to a bronze table in micro-batches; rows older than the newest stamp before the batch by ``max_late_days`` go aside.

    A version is a row that differs in keys, values or stamps. Bronze is stored by day (``_day``) and a batch reads only
    the days its rows can fall on. A batch that is run again adds nothing. Silver is ``silver_of`` the bronze table.
    """
    marks = f"{checkpoint.rstrip('/')}-marks"
    batch = lambda df, number: upsert_batch(df, number, keys, values, ts, newest, bronze, late, marks, max_late_days)
    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def silver_of(bronze: DataFrame, keys: Sequence[str], newest: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    return dedup_latest(bronze, keys, [newest], tiebreak)


# --- the same split with keyed state --------------------------------------------------------------------------------------

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Days a version stays known after the watermark has passed its stamp; a repeat that comes later lands again.
KEEP_DAYS = 30
#: Shares a place's day is dealt over by the version's hash; a running stream's checkpoint belongs to its number.
SHARES = 8
#: Blocks of digests a group stores before they are joined into one.
MOST_BLOCKS = 64
DIGEST = np.dtype("S16")


class Known:
    """Digests told from earlier ones: sorted blocks, each over twice the next, so an addition merges a logarithm of them."""

    def __init__(self) -> None:
        self.blocks: list[np.ndarray] = []

    def add(self, digests: np.ndarray) -> None:
        if len(digests):
            self.blocks.append(np.sort(digests))
        while len(self.blocks) > 1 and len(self.blocks[-2]) <= 2 * len(self.blocks[-1]):
            self.blocks.append(np.sort(np.concatenate([self.blocks.pop(), self.blocks.pop()])))

    def holds(self, digests: np.ndarray) -> np.ndarray:
        out = np.zeros(len(digests), bool)
        for block in self.blocks:
            out |= block[np.minimum(np.searchsorted(block, digests), len(block) - 1)] == digests
        return out


class Versions(StatefulProcessor):
    """Per group: the versions seen lately, so that a repeat is dropped, each until the watermark has left its stamp behind.

    Groups are shares of a place's rows by stamp (a place, a day and a share of the versions), so a group's versions leave
    the state together, by one timer: the state holds the days within lateness and ``keep_ms``, however long the stream runs.
    Digests are read and stored in blocks, a few calls a group and batch: a call for each row costs more than all the rest.
    """

    def __init__(self, columns: list[str], keep_ms: int):
        self.columns, self.keep_ms = columns, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", "digests binary")

    def handleInputRows(self, key, rows, timerValues):
        mark = timerValues.getCurrentWatermarkInMs()
        newest, known, added = None, Known(), []
        stored = [bytes(block) for (block,) in self.seen.get()]
        known.add(np.frombuffer(b"".join(stored), DIGEST))
        for part in rows:
            digests, first = np.unique(np.frombuffer(b"".join(part["version_id"]), DIGEST), return_index=True)
            fresh = ~known.holds(digests)
            if len(part):
                newest = max(int(part["stamp_ms"].max()), newest or 0)
            if fresh.any():
                known.add(digests[fresh])
                added.append(digests[fresh].tobytes())
                at = np.sort(first[fresh])
                out = part.iloc[at][self.columns].copy()
                out["is_late"] = (part.iloc[at]["stamp_ms"] < mark).to_numpy()
                yield out
        if added and len(stored) < MOST_BLOCKS:
            self.seen.appendValue((b"".join(added),))
        elif added:
            self.seen.put([(b"".join(stored + added),)])
        if newest is not None:
            self.handle.registerTimer(max(newest, mark) + self.keep_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not any(t > expiredTimerInfo.getExpiryTimeInMs() for t in self.handle.listTimers()):
            self.seen.clear()
        yield from ()

    def close(self) -> None:
        pass


def stream_versions(
    rows: DataFrame, keys: Sequence[str], values: Sequence[str], ts: str, newest: str, path: str, checkpoint: str, max_late_days: int = 7, keep_days: int = KEEP_DAYS
) -> StreamingQuery:
    """``stream_upsert_silver`` without reading what was written: new versions and late rows are told from keyed state.

    ``path`` holds batch=<n>/is_late=<0 or 1>/ folders; a batch that is run again replaces its own. A row is late
    if its stamp lies before the watermark, the newest stamp of earlier batches less ``max_late_days``; a version is a row
    that differs in keys, values or stamps, and a repeat, in time or late, is dropped while its day is in the state. Needs the RocksDB state
    store (``spark.sql.streaming.stateStore.providerClass``).
    """
    same = list(dict.fromkeys([*keys, *values, newest, ts]))
    stamped = rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{max_late_days} days")
    version = F.unhex(F.left(F.sha2(F.to_json(F.struct(*same), {"ignoreNullFields": "false"}), 256), F.lit(2 * DIGEST.itemsize)))
    group = [k for k in keys if k != ts]
    # as a number the stamp carries no watermark, so late rows reach the processor and are told apart there
    plain = [F.col(c).cast("string").alias(c) if c == ts else F.col(c) for c in rows.columns]
    keyed = stamped.select(*plain, F.unix_millis(ts).alias("stamp_ms"), F.to_date(F.col(ts)).cast("string").alias("stamp_day"), version.alias("version_id"))
    keyed = keyed.withColumn("version_share", F.pmod(F.xxhash64("version_id"), F.lit(SHARES)))
    out = StructType([*(f for f in keyed.schema.fields if f.name in rows.columns)]).add("is_late", "boolean")
    processor = Versions(rows.columns, keep_days * 86_400_000)
    told = keyed.groupBy(*group, "stamp_day", "version_share").transformWithStateInPandas(processor, out, "Append", "EventTime")
    back = told.withColumn(ts, F.col(ts).cast(rows.schema[ts].dataType))

    def write(df: DataFrame, number: int) -> None:
        df.withColumns({"batch": F.lit(number), "is_late": F.col("is_late").cast("int")}).write.partitionBy("batch", "is_late").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)

    return back.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
