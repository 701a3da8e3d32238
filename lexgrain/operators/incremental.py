"""Processing only new or changed records of a log, exactly once, whatever fails in between.

The log is cut into partitions by a hash of its key; the offset in a partition is the arrival time in microseconds.  A
batch plan (the offsets at which each partition's span starts and ends) is written ahead of the work.  A run that finds
plans without commit replays exactly those, all in one pass over the log, before it makes a new one.  The sink keeps rows
by (key, offset, digest) and so takes a replayed row only once.  What keys were last taken up as is compacted now and then,
so a run reads the last state and the few batches since, not the whole sink.

Defined results: rows without key, digest or arrival time deliver nothing; repeated rows count once; of rows of a
key with one arrival time the greatest digest counts; content that goes back to an earlier state is a change; an
empty log or no runs give an empty result.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Partitions of the log, each with its own offsets.
LOG_PARTITIONS = 64
#: Batches after which the state is compacted.
COMPACT = 8
#: Plans that are made or replayed in one pass.
BACKLOG = 64
OPEN_RUN = 0


def log_partition(key: Column, partitions: int = LOG_PARTITIONS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")


def offset_of(at: Column) -> Column:
    """Microseconds since 1970 of a time without zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, at.cast("timestamp_ntz"))


def deliveries(files: DataFrame) -> DataFrame:
    """raw_id, arrived_at, offset, sha256 of the rows that deliver content."""
    there = (F.col("status") == "new") & F.col("raw_id").isNotNull() & F.col("sha256").isNotNull() & F.col("arrived_at").isNotNull()
    return files.where(there).select("raw_id", "arrived_at", offset_of(F.col("arrived_at")).alias("offset"), "sha256")


def _time(offset: int) -> Column:
    """The time of an offset, for the scan to skip what lies before or behind."""
    return F.lit(str(dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=offset))).cast("timestamp_ntz")


def finished_runs(runs: DataFrame) -> DataFrame:
    """run_id, started_at of runs one of whose rows says finished."""
    named = runs.where(F.col("run_id").isNotNull()).groupBy("run_id").agg(F.max(F.col("status") == "finished").alias("ok"), F.min("started_at").alias("started_at"))
    return named.where(F.col("ok") & F.col("started_at").isNotNull()).select("run_id", "started_at")


class Store:
    """Small JSON files and sink folders below a shared folder, through Hadoop's file system API."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str) -> object:
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return sorted(f.getPath().getName() for f in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def move(self, name: str, to: str) -> None:
        """Rename a folder to a name that is not there yet; what stands under that name is never touched."""
        if self.exists(to):
            raise OSError(f"{self.root}/{to} is there already")
        self._fs.mkdirs(self._path(to).getParent())
        if not self._fs.rename(self._path(name), self._path(to)):
            raise OSError(f"{self.root}/{name} could not be renamed to {to}")

    def write(self, name: str, value: dict) -> None:
        """Write under another name and rename, so that a file is there whole or not at all."""
        part = self._path(f"tmp/{uuid.uuid4().hex}")
        out = self._fs.create(part, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        self._fs.mkdirs(self._path(name).getParent())
        if not self._fs.rename(part, self._path(name)):
            self._fs.delete(part, False)
            raise OSError(f"{self.root}/{name} could not be written")

    def load(self, name: str) -> dict:
        stream = self._fs.open(self._path(name))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()


class Feed:
    """Takes new and changed records of a log run by run, exactly once.

    State below `root`: plans/N.json (written ahead), commits/N.json, sink/batch=N (what batch N took up; nothing for an
    empty batch) and state/N (the last digest of every key after batch N).  A folder gets its name by one rename after the
    work is done, batch after batch, so a plan without commit whose sink folder is there is whole and only needs its
    commit; a plan without folder is worked on again.  A state is made of the sink alone, so one that is missing costs
    time and nothing else.
    """

    SINK = "raw_id long, offset long, sha256 string"

    def __init__(self, spark: SparkSession, root: str, partitions: int = LOG_PARTITIONS, compact: int = COMPACT) -> None:
        self.spark, self.partitions, self.compact, self._store = spark, partitions, compact, Store(spark, root)

    def _numbers(self, folder: str) -> list[int]:
        return [int(n.split(".")[0]) for n in self._store.names(folder)]

    def pending(self) -> dict[int, dict]:
        """Plans without commit, in order."""
        done = max(self._numbers("commits"), default=-1)
        return {n: self._store.load(f"plans/{n:010d}.json") for n in self._numbers("plans") if n > done}

    def plan(self, log: DataFrame, times: list[str | None]) -> None:
        """Write plans ahead, one for each time (ascending; None: after all rows), behind all plans there are.

        A plan ends, in each partition, at the last row there that arrived before its time; where nothing is new it ends
        where it starts.  One pass over the log finds the ends of up to BACKLOG plans.
        """
        numbers = self._numbers("plans")
        number = max(numbers, default=-1) + 1
        after = self._store.load(f"plans/{numbers[-1]:010d}.json")["until"] if numbers else [None] * self.partitions
        for k in range(0, len(times), BACKLOG):
            some = times[k : k + BACKLOG]
            bounds = F.array(*[offset_of(F.lit(t)) if t else F.lit(2**63 - 1) for t in some])
            turn = F.size(F.filter(bounds, lambda b: b <= F.col("offset")))  # the first plan whose time is after the row
            rows = self._span(log, after, None).groupBy(log_partition(F.col("raw_id"), self.partitions).alias("part"), turn.alias("turn"))
            found = {(r["part"], r["turn"]): r["end"] for r in rows.agg(F.max("offset").alias("end")).collect()}  # partitions x plans
            for turn_ in range(len(some)):
                until = [max((x for x in (after[p], found.get((p, turn_))) if x is not None), default=None) for p in range(self.partitions)]
                self._store.write(f"plans/{number:010d}.json", {"after": after, "until": until})
                after, number = until, number + 1

    def _span(self, log: DataFrame, after: list[int | None], until: list[int | None] | None) -> DataFrame:
        """Deliveries of which some partition may want more: behind the least start, up to the greatest end."""
        rows = deliveries(log)
        if None not in after:
            rows = rows.where((F.col("offset") > min(after)) & (F.col("arrived_at") >= _time(min(after))))
        if until is not None:
            last = max((x for x in until if x is not None), default=None)
            rows = rows.where(F.lit(False)) if last is None else rows.where((F.col("offset") <= last) & (F.col("arrived_at") <= _time(last)))
        return rows

    def _read(self, paths: list[str]) -> DataFrame:
        whole = [f"{self._store.root}/{p}" for p in paths]
        return self.spark.read.schema(StructType.fromDDL(self.SINK)).parquet(*whole) if whole else self.spark.createDataFrame([], self.SINK)

    def _batches_of(self, low: int, high: int | None) -> list[str]:
        """Sink folders of the batches from `low` on and below `high`."""
        numbers = {n: int(n.split("=")[1]) for n in self._store.names("sink")}
        return [f"sink/{n}" for n, k in numbers.items() if low <= k and (high is None or k < high)]

    def taken(self) -> DataFrame:
        """The sink, each key, offset and digest once."""
        return self._read(self._batches_of(0, None)).distinct()

    def held(self, before: int) -> DataFrame:
        """raw_id, offset, sha256 last taken up for every key by the batches below `before`."""
        states = [n for n in self._store.names("state") if int(n) < before]
        since = self._read(self._batches_of(int(states[-1]) + 1 if states else 0, before) + ([f"state/{states[-1]}"] if states else []))
        return since.groupBy("raw_id").agg(F.max(F.struct("offset", "sha256")).alias("n")).select("raw_id", "n.*")

    def taking(self, log: DataFrame, plans: dict[int, dict]) -> DataFrame:
        """SINK and batch of the rows in the spans of consecutive plans that differ from what was taken up for their key before.

        Per key and batch the newest row counts; it is compared with that of the batch before, or with the state.
        """
        first, last = plans[min(plans)], plans[max(plans)]
        low = -(2**63)
        ends = [[low if p["until"][k] is None else p["until"][k] for p in plans.values()] for k in range(self.partitions)]
        spans = self.spark.createDataFrame([(k, low if first["after"][k] is None else first["after"][k], ends[k]) for k in range(self.partitions)], "part int, after long, ends array<long>")
        rows = self._span(log, first["after"], last["until"]).withColumn("part", log_partition(F.col("raw_id"), self.partitions))
        within = rows.join(F.broadcast(spans), "part").where((F.col("offset") > F.col("after")) & (F.col("offset") <= F.element_at("ends", -1)))  # one row per log partition
        turn = F.size(F.filter("ends", lambda e: e < F.col("offset")))
        newest = within.groupBy("raw_id", (turn + min(plans)).cast("long").alias("batch")).agg(F.max(F.struct("offset", "sha256")).alias("n")).select("raw_id", "batch", "n.*")
        both = newest.unionByName(self.held(min(plans)).withColumn("batch", F.lit(-1).cast("long")))
        before = F.lag("sha256").over(Window.partitionBy("raw_id").orderBy("batch"))  # one row per key and batch
        return both.withColumn("before", before).where((F.col("batch") >= 0) & (F.col("before").isNull() | (F.col("before") != F.col("sha256")))).drop("before")

    def batches(self) -> DataFrame:
        """raw_id and the number of the batch that took it up, for every row of the sink."""
        if not self._store.names("sink"):
            return self.spark.createDataFrame([], "raw_id long, batch long")
        held = self.spark.read.schema(StructType.fromDDL(f"{self.SINK}, batch long")).parquet(f"{self._store.root}/sink")
        return held.groupBy("raw_id", "offset", "sha256").agg(F.min("batch").alias("batch")).select("raw_id", "batch")

    def replay(self, log: DataFrame, work: Callable[[DataFrame], object] | None = None) -> int:
        """Take up, work, commit, batch by batch, for all plans without commit; returns the number of the last one.

        An exception leaves the rest to be replayed.  A batch that is in the sink already was worked on and is only
        committed.
        """
        plans = self.pending()
        while plans:
            sunk = {int(n.split("=")[1]) for n in self._store.names("sink")}
            todo = dict([x for x in plans.items() if x[0] not in sunk][:BACKLOG])
            staged = f"staged/{min(todo):010d}" if todo else ""
            if todo:
                self.taking(log, todo).repartition("batch", "raw_id").write.mode("overwrite").partitionBy("batch").parquet(f"{self._store.root}/{staged}")
            for number in [n for n in plans if n in todo or n in sunk]:
                own = f"{staged}/batch={number}"
                if number in todo and self._store.exists(own):
                    if work:
                        work(self._read([own]))
                    self._store.move(own, f"sink/batch={number:010d}")
                self._store.write(f"commits/{number:010d}.json", plans.pop(number))
        done = max(self._numbers("commits"), default=-1)
        if done - max((int(n) for n in self._store.names("state")), default=-1) >= self.compact:
            self.compacted(done)
        return done

    def run(self, log: DataFrame, as_of: str | None, work: Callable[[DataFrame], object] | None = None) -> int:
        """Replay what is planned, else plan a batch up to `as_of` and take it up; returns the number of the last batch."""
        if not self.pending():
            self.plan(log, [as_of])
        return self.replay(log, work)

    def compacted(self, number: int) -> None:
        """Write the state after a batch."""
        name, staged = f"state/{number:010d}", f"staged/state-{number:010d}"
        if not self._store.exists(name):
            self.held(number + 1).write.mode("overwrite").parquet(f"{self._store.root}/{staged}")
            self._store.move(staged, name)


def feed_runs(files: DataFrame, runs: DataFrame, root: str, partitions: int = LOG_PARTITIONS) -> DataFrame:
    """run_id, raw_id: what every finished run takes up, and OPEN_RUN for the next one, by a Feed below the new folder `root`.

    One batch per finished run, in order of start; a run that did not finish commits nothing, so it has no batch and
    the next one goes on from the offsets committed last.  All are planned ahead, and then replayed as a feed does that
    comes back after it was away for that long.
    """
    feed = Feed(files.sparkSession, root, partitions)
    ran = finished_runs(runs).select("run_id", "started_at", F.col("started_at").cast("string").alias("as_of")).orderBy("started_at", "run_id").collect()
    feed.plan(files, [*[r["as_of"] for r in ran], None])
    feed.replay(files)
    run = F.array(*[F.lit(x).cast("long") for x in [*[r["run_id"] for r in ran], OPEN_RUN]])
    return feed.batches().select(F.get(run, F.col("batch").cast("int")).alias("run_id"), "raw_id")
