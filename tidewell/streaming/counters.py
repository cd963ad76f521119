"""Sighting counters as keyed state of a stream, merged into a bucketed table.

The state of a key is three numbers in Spark's state store, whatever the length of its history: a
micro-batch reads and writes the keys that it brings, and the table's buckets of these keys, nothing
else. The rows of a key come in as Arrow batches, so a key with very many sightings needs no memory
for them.

No sighting is ever late: no watermark drops rows. With quiet_ms a timer on processing time tells of
keys that no batch has brought for so long; such a query looks at its timers as long as it runs, so it
wants a trigger that repeats, not availableNow. A batch that is
replayed after a failure starts from the state that its predecessor left, and its merge replaces rows
by rows that are equal, so that every sighting counts once.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidewell.operators.buckets import Buckets
from tidewell.operators.kept import kept
from tidewell.session import ship

COUNTERS = ["first_seen", "latest_seen", "seen_count"]
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def counter(keys: list[str], quiet_ms: int | None) -> StatefulProcessor:
    """The processor of a key's sightings. It is a class of its own here so that it travels whole: the process that reads its state's schema has no package of ours."""

    class Counter(StatefulProcessor):
        """first_seen, latest_seen and seen_count of a key; with quiet_ms, a key that no batch has brought for so long is told as quiet, once."""

        def init(self, handle) -> None:
            self.handle = handle
            self.held = handle.getValueState("counter", "first_seen long, latest_seen long, seen_count long")

        def _told(self, key, counter, quiet: bool) -> pd.DataFrame:
            return pd.DataFrame([(*key, *counter, quiet)], columns=[*keys, *COUNTERS, "is_quiet"])

        def handleInputRows(self, key, rows, timerValues):
            first, latest, n = self.held.get() if self.held.exists() else (None, None, 0)
            for batch in rows:
                seen = batch["seen_at"]
                first = int(seen.min()) if first is None else min(first, int(seen.min()))
                latest = int(seen.max()) if latest is None else max(latest, int(seen.max()))
                n += len(seen)
            self.held.update((first, latest, n))
            if quiet_ms is not None:
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + quiet_ms)
            yield self._told(key, (first, latest, n), False)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            yield self._told(key, self.held.get(), True)

        def close(self) -> None:
            pass

    return Counter()


def counted(stream: DataFrame, keys: list[str], quiet_ms: int | None = None) -> DataFrame:
    """The counters of the keys that each micro-batch brings, and of those that have become quiet. seen_at is a long; null ones are no sightings."""
    ship(stream.sparkSession)
    kinds = dict(stream.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), *(f"{c} long" for c in COUNTERS), "is_quiet boolean"])
    sightings = stream.select(*keys, "seen_at").where("seen_at is not null")
    return sightings.groupBy(*keys).transformWithStateInPandas(counter(keys, quiet_ms), schema, "Update", "None" if quiet_ms is None else "ProcessingTime")


def keep(stream: DataFrame, keys: list[str], table: str, checkpoint: str, quiet_ms: int | None = None, buckets: int = 64, **trigger):
    """Starts a query that keeps the counters of stream in a bucketed table at the path table, which is made if absent; trigger as for writeStream."""
    spark = stream.sparkSession
    counters = counted(stream, keys, quiet_ms)

    def merge(batch: DataFrame, _: int) -> None:
        batch = kept(batch, "counted")  # read several times below; the state is read once
        try:
            there = Buckets.open(batch.sparkSession, table)
        except Exception as e:  # no table yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            there = Buckets.create(batch.limit(0), table, keys, buckets)
        there.upsert(batch, [F.desc("seen_count"), F.desc("is_quiet")])

    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return counters.writeStream.foreachBatch(merge).outputMode("update").option("checkpointLocation", checkpoint).trigger(**trigger).start()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)
