"""A ledger of deliveries: which files of a folder were claimed by which increment.

A delivery is a path together with its time and length, so a name that is delivered again is another delivery, also if
its time was kept, as long as its length differs. Deliveries that are not in the ledger are claimed: written, a bounded
number at a time, to a claim file under a number of its own. The stream reads claim files, so its own memory of paths
is right, and an increment that is tried again gets the same deliveries.

Claims whose increment is committed are settled at the next look: their files go to the archive, if there is one, and
only deliveries that still lie in the folder are remembered, in one table. So the ledger is as large as the folder.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from threading import Event, Lock, Thread

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from specflow.plans.spec import SpecError
from specflow.sinks.storage import delete, exists, file_status, move, names_in, write_text
from specflow.streaming.trigger import NO_AGE_LIMIT, started

_DELIVERY = "path string, time bigint, length bigint"
_KEY = ["path", "time", "length"]


class Deliveries:
    """The deliveries to one folder, as one checkpoint remembers them. One run at a time may use a checkpoint."""

    def __init__(self, session: SparkSession, location: str, checkpoint: str, archive: str | None = None, max_files: int | None = None) -> None:
        self.session = session
        self.location = location.rstrip("/")
        self.checkpoint = checkpoint
        self.archive = archive
        self.max_files = max_files
        self._claims, self._known = f"{checkpoint}/deliveries", f"{checkpoint}/known"
        self._lock = Lock()

    def look(self) -> int:
        """Settle what is committed and claim what has arrived; gives the number of new claims."""
        with self._lock:
            there = self._there()
            self._settle(there)
            return self._claim(self._there() if self.archive else there)

    def stream(self) -> DataFrame:
        """The claimed deliveries, an increment at a time."""
        if exists(self.session, f"{self.checkpoint}/sources/0") and not exists(self.session, self._claims):
            raise SpecError(f"{self.checkpoint} belongs to a stream that remembers paths alone; begin another one")
        write_text(self.session, f"{self._claims}/.folder", "")
        reader = self.session.readStream.schema(_DELIVERY).option("maxFilesPerTrigger", 1).option("maxFileAge", NO_AGE_LIMIT)
        return reader.json(self._claims)

    def paths(self, claimed: Iterable[Row]) -> list[str]:
        """Where the claimed files are now. One that was replaced before it was read is left to its own delivery."""
        found = (next((p for p in self._places(d) if file_status(self.session, p) == (d.time, d.length)), None) for d in claimed)
        return [path for path in found if path is not None]

    def start(self, writer: DataStreamWriter, every: str | None) -> StreamingQuery | RunningDeliveries:
        """Work off what has arrived and stop, or look for deliveries at an interval."""
        self.look()
        query = started(writer.option("checkpointLocation", self.checkpoint), every)
        return query if every is None else RunningDeliveries(self, query, every)

    def _places(self, delivery: Row) -> list[str]:
        return [delivery.path, *(self._archived(delivery) if self.archive else [])]

    def _archived(self, delivery: Row) -> list[str]:
        """Its place in the archive, and the one it gets where that is taken."""
        below = delivery.path[len(_plain(self.location)) :].lstrip("/") if delivery.path.startswith(_plain(self.location)) else ""
        below = below or delivery.path.rpartition("/")[2]
        folder, slash, name = below.rpartition("/")
        stem, dot, ending = name.partition(".")
        return [f"{self.archive}/{below}", f"{self.archive}/{folder}{slash}{stem}-{delivery.time}-{delivery.length}{dot}{ending}"]

    def _there(self) -> DataFrame:
        """The files that lie in the folder. Their contents are not read."""
        if not exists(self.session, self.location):
            return self.session.createDataFrame([], _DELIVERY)
        files = self.session.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.location)
        return files.select(_plain_path(F.col("path")).alias("path"), F.unix_millis("modificationTime").alias("time"), "length")

    def _numbers(self, folder: str) -> list[int]:
        stems = (name.partition(".")[0] for name in names_in(self.session, folder))
        return sorted(int(stem) for stem in stems if stem.isdigit())

    def _ledger(self) -> DataFrame:
        claims = [f"{self._claims}/{n:012d}.json" for n in self._numbers(self._claims)]
        claimed = self.session.read.schema(_DELIVERY).json(claims) if claims else self.session.createDataFrame([], _DELIVERY)
        return claimed.unionByName(self._remembered())

    def _remembered(self) -> DataFrame:
        numbers = self._numbers(self._known)
        if numbers:
            return self.session.read.schema(_DELIVERY).parquet(f"{self._known}/{numbers[-1]}")
        return self.session.createDataFrame([], _DELIVERY)

    def _log(self) -> DataFrame | None:
        """What the stream has read: path, time, batch."""
        log = f"{self.checkpoint}/sources/0"
        if not exists(self.session, log):
            return None
        entry = F.from_json("value", "path string, timestamp long, batchId long").alias("e")
        entries = self.session.read.text(log).where(F.col("value").startswith("{")).select(entry)
        path = _plain_path(F.url_decode(F.replace("e.path", F.lit("+"), F.lit("%2B"))))
        return entries.select(path.alias("path"), F.col("e.timestamp").alias("time"), F.col("e.batchId").alias("batch"))

    def _settle(self, there: DataFrame) -> None:
        committed = self._numbers(f"{self.checkpoint}/commits")
        log = self._log()
        if log is None or not committed:
            return
        names = {r.path.rpartition("/")[2] for r in log.where(F.col("batch") <= committed[-1]).select("path").collect()}
        done = [f"{self._claims}/{n:012d}.json" for n in self._numbers(self._claims) if f"{n:012d}.json" in names]
        if not done:
            return
        claimed = self.session.read.schema(_DELIVERY).json(done)
        if self.archive:
            for delivery in claimed.toLocalIterator():
                self._to_archive(delivery)
            there = self._there()
        left = claimed.unionByName(self._remembered()).join(there, _KEY, "semi").distinct()
        before = self._numbers(self._known)
        left.write.mode("overwrite").parquet(f"{self._known}/{before[-1] + 1 if before else 0}")
        for claim in done:
            delete(self.session, claim)
        for number in before:
            delete(self.session, f"{self._known}/{number}")

    def _to_archive(self, delivery: Row) -> None:
        if file_status(self.session, delivery.path) == (delivery.time, delivery.length):
            target = next((p for p in self._archived(delivery) if not exists(self.session, p)), None)
            if target is not None:
                move(self.session, delivery.path, target)

    def _claim(self, there: DataFrame) -> int:
        new = there.join(self._ledger(), _KEY, "left_anti").orderBy("time", "path")
        numbers = self._numbers(self._claims) + self._claimed_before()
        number, claims, held = max(numbers, default=-1) + 1, 0, []
        for delivery in new.toLocalIterator():
            held.append(json.dumps(delivery.asDict()))
            if len(held) == self.max_files:
                write_text(self.session, f"{self._claims}/{number + claims:012d}.json", "\n".join(held) + "\n")
                claims, held = claims + 1, []
        if held:
            write_text(self.session, f"{self._claims}/{number + claims:012d}.json", "\n".join(held) + "\n")
            claims += 1
        return claims

    def _claimed_before(self) -> list[int]:
        """The numbers of claims that the stream has read: names must not come again, also of settled ones."""
        log = self._log()
        if log is None:
            return []
        last = log.select(F.max(F.regexp_extract("path", r"/deliveries/(\d+)\.json$", 1).try_cast("long")).alias("n")).first().n
        return [] if last is None else [last]


class RunningDeliveries:
    """A query that keeps running, with a thread that looks for deliveries at its interval."""

    def __init__(self, deliveries: Deliveries, query: StreamingQuery, every: str) -> None:
        self._deliveries, self._query = deliveries, query
        self._stopped = Event()
        seconds = deliveries.session.sql(f"SELECT CAST(INTERVAL {every} AS INTERVAL DAY TO SECOND) AS i").first().i.total_seconds()
        self._thread = Thread(target=self._watch, args=(max(seconds, 0.1),), daemon=True)
        self._failure: BaseException | None = None
        self._thread.start()

    def _watch(self, seconds: float) -> None:
        try:
            while not self._stopped.wait(seconds) and self._query.isActive:
                self._deliveries.look()
        except Exception as failure:
            if not self._stopped.is_set():
                self._failure = failure
                self._query.stop()

    def _raise(self) -> None:
        if self._failure is not None:
            raise self._failure

    def processAllAvailable(self) -> None:
        """Return when everything that has been delivered so far is processed."""
        self._raise()
        self._deliveries.look()
        self._query.processAllAvailable()
        self._raise()

    def awaitTermination(self, timeout: int | None = None) -> bool | None:
        ended = self._query.awaitTermination(timeout) if timeout is not None else self._query.awaitTermination()
        self._raise()
        return ended

    def stop(self) -> None:
        self._stopped.set()
        self._thread.join()
        self._query.stop()

    def __getattr__(self, name: str):
        return getattr(self._query, name)


def _plain_path(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


def _plain(path: str) -> str:
    """A local path as listings name it."""
    return f"file:{path}" if path.startswith("/") else path
