"""Crawl snapshots as a stream with state: ads of a board and what becomes of them, without reading what is stored.

A snapshot comes as ads (board, job_key, day, ordinal, pay) and a mark (job_key NULL) that says whether the board was
fetched well. Ads wait for their day's mark; if none has come when snapshots are GRACE beyond the day, a timer drops
them, as those of a board that failed. State is kept by board and bucket of the ad's key, so one large board is dealt out; each
bucket gets the board's marks.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from operator import itemgetter

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

EVENTS = "board string, job_key string, day string, ordinal long, pay double, ok boolean"
CHANGES = "board string, job_key string, first_seen string, last_seen string, is_active int, pay double, day string"
#: How long ads wait for their mark (and how late rows may come), and buckets of a board.
GRACE, BUCKETS = "3 days", 16
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Parts in which a bucket's ads are kept: each is read and written whole, as JSON, so that state is asked for by parts and
#: not by ads, and held in memory one at a time.
PARTS = 64
Change = Row("board", "job_key", "first_seen", "last_seen", "is_active", "pay", "day")


def part_of(job_key: str) -> int:
    return zlib.crc32(job_key.encode()) % PARTS


class Snapshots(StatefulProcessor):
    """Ads of a board's bucket. What one batch brings of a bucket is held in memory; of what is stored, one part is."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Of a part {job_key: [first_seen, last_seen, is_active, pay]}, and of a day and part {job_key: [ordinal, pay]}.
        self.ads = handle.getMapState("ads", "part int", "held string")
        self.waiting = handle.getMapState("waiting", "day string, part int", "held string")
        self.days = handle.getMapState("days", "day string", "deadline long")
        self.last = handle.getValueState("last", "day string")

    @staticmethod
    def held(state, *key) -> dict[str, list]:
        return json.loads(state.getValue(key)[0]) if state.containsKey(key) else {}

    @staticmethod
    def later(found: dict[str, list], more: dict[str, list]) -> dict[str, list]:
        """found with what more has of each ad, of two the one with the greater ordinal, of equal ones the first."""
        for job_key, new in more.items():
            if job_key not in found or found[job_key][0] < new[0]:
                found[job_key] = new
        return found

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        marks: dict[str, bool] = {}
        come: dict[str, dict[int, dict[str, list]]] = {}
        deadlines: dict[str, int] = {}
        last = self.last.get()[0] if self.last.exists() else ""
        columns = None
        for r in rows:
            columns = columns or itemgetter(*map(r.__fields__.index, ("job_key", "day", "ordinal", "pay", "ok", "at")))
            job_key, day, ordinal, pay, ok, at = columns(r)
            if job_key is None:
                # Where marks of a day disagree the board failed.
                marks[day] = marks.get(day, True) and bool(ok)
            elif day > last:  # a snapshot older than the one that counts is of no use
                if day not in come:
                    come[day], deadlines[day] = {}, int(at.timestamp() * 1000) + 1
                part = come[day].setdefault(part_of(job_key), {})
                if job_key not in part or part[job_key][0] < ordinal:
                    part[job_key] = [ordinal, pay]
        stored = {day for day in {*marks, *come} if self.days.containsKey((day,))}
        counts = [day for day in sorted(marks) if marks[day] and day > last]
        if counts:
            for part in range(PARTS):
                yield from self.apply(key[0], part, counts, come, stored)
            self.last.update((counts[-1],))
        for day in marks:
            if day in stored:
                self.handle.deleteTimer(self.days.getValue((day,))[0])
                self.drop(day)
        for day in come.keys() - marks.keys():
            for part, more in come[day].items():
                self.waiting.updateValue((day, part), (json.dumps(self.later(self.held(self.waiting, day, part), more)),))
            if day not in stored:
                self.days.updateValue((day,), (deadlines[day],))
                self.handle.registerTimer(deadlines[day])

    def apply(self, board: str, part: int, days: list[str], come: dict, stored: set[str]) -> Iterator[Row]:
        """Ads of each day are active; those of earlier days that aren't among them become inactive."""
        ads = self.held(self.ads, part)
        changed = False
        for day in days:
            seen = self.later(self.held(self.waiting, day, part) if day in stored else {}, come.get(day, {}).get(part, {}))
            for job_key, (_, pay) in seen.items():
                first = ads[job_key][0] if job_key in ads else day
                ads[job_key] = [first, day, 1, pay]
                yield Change(board, job_key, first, day, 1, pay, day)
                changed = True
            for job_key, ad in ads.items():
                if ad[2] == 1 and job_key not in seen:
                    ad[2] = 0
                    yield Change(board, job_key, ad[0], ad[1], 0, ad[3], day)
                    changed = True
        if changed:
            self.ads.updateValue((part,), (json.dumps(ads),))

    def drop(self, day: str) -> None:
        for part in range(PARTS):
            if self.waiting.containsKey((day, part)):
                self.waiting.removeKey((day, part))
        self.days.removeKey((day,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        for day in [k[0] for k, v in self.days.iterator() if v[0] <= now]:
            self.drop(day)
        yield from ()

    def close(self) -> None:
        pass


def bucketed(events: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Ads with the bucket of their key, and marks once for each bucket."""
    own = F.pmod(F.xxhash64("job_key"), F.lit(buckets)).cast("int")
    every = F.sequence(F.lit(0), F.lit(buckets - 1))
    return events.withColumn("bucket", F.explode(F.when(F.col("job_key").isNull(), every).otherwise(F.array(own)))).withColumn("at", F.to_timestamp("day"))


def follow(spark: SparkSession, source: str, sink: str, checkpoint: str, files_at_once: int = 8, buckets: int = BUCKETS) -> StreamingQuery:
    """Reads new files of EVENTS as they come and appends what changes (CHANGES) to Parquet under sink."""
    before = spark.conf.get(PROVIDER)
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_at_once).parquet(source)
    keyed = bucketed(stream, buckets).withWatermark("at", GRACE)
    changes = keyed.groupBy("board", "bucket").transformWithState(Snapshots(), CHANGES, "Append", "eventTime")
    spark.conf.set(PROVIDER, ROCKS)
    try:
        return changes.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", sink).trigger(availableNow=True).start()
    finally:
        spark.conf.set(PROVIDER, before)


def state(spark: SparkSession, sink: str) -> DataFrame:
    """The ads after all changes: of each the last one."""
    changes = spark.read.schema(CHANGES).parquet(sink)
    own = ("board", "first_seen", "last_seen", "is_active", "pay")
    return changes.groupBy("job_key").agg(F.max_by(F.struct(*own), "day").alias("a")).select("a.board", "job_key", *(f"a.{c}" for c in own[1:]))
