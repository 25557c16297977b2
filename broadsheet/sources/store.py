"""The archive as append-only Parquet tables behind a log of commits.

A run writes all its rows below an attempt of its own, ``<table>/attempt=<id>``,
and becomes visible with one marker, ``commits/<version>.json``, that is created
last and never replaced. Readers follow the log: of each run they see the last
attempt that was committed, so a run that failed half way is never seen and a
repeated run replaces its earlier attempt. No write touches a file that a
reader may hold; ``Store.at`` reads the state of an earlier version.

What a run takes back is written as rows of ``removed``: a key of a table, dead
in all versions before the run's own. Bodies replaced by a refresh, days whose
snapshot is taken again and index rows of a record indexed again are such keys.
They are few, so reading joins a small table, and bodies stay where they lie.

``items`` and ``contents`` are partitioned by attempt and source, ``snapshots``
by attempt, source and day, ``index`` by attempt and archive date.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace
from functools import cached_property

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.operators import history, merge
from broadsheet.operators.records import archive_records, records_union, snapshot_records
from broadsheet.schemas import ARCHIVE_ITEM, MANIFEST_ROW, RANKED_ITEM, SNAPSHOT_ITEM

_S, _L, _B = T.StringType(), T.LongType(), T.BooleanType()


def _schema(*pairs) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in pairs])


def _with(schema: T.StructType, *pairs) -> T.StructType:
    return T.StructType(schema.fields + _schema(*pairs).fields)


INDEX = _schema(
    ("record_id", _S), ("source_id", _S), ("source_name", _S), ("kind", _S), ("title", _S),
    ("url", _S), ("archived_at", _S), ("published_at", _S), ("author", _S), ("snapshot_date", _S),
    ("rank", T.IntegerType()), ("comments_count", _L), ("score", _L),
    ("extra", T.MapType(_S, _S)), ("item_id", _S), ("content_path", _S),
    ("archived_ts", T.TimestampType()), ("source_pos", T.IntegerType()), ("item_pos", _L),
    ("archived_date", T.DateType()),
)

# Table name: schema and partition columns below the attempt.
TABLES = {
    "items": (_with(MANIFEST_ROW, ("item_pos", _L), ("landed_run", _S)), ["source_id"]),
    "contents": (
        _schema(
            ("content_path", _S), ("item_id", _S), ("content", _S), ("stale", _B),
            ("refreshed", _B), ("source_id", _S),
        ),
        ["source_id"],
    ),
    "snapshots": (
        _with(
            SNAPSHOT_ITEM, ("item_pos", _L), ("taken_at", _S), ("source_id", _S), ("snapshot_date", _S)
        ),
        ["source_id", "snapshot_date"],
    ),
    "index": (INDEX, ["archived_date"]),
    "runs": (
        _schema(
            ("source_id", _S), ("status", _S), ("fetched", _L), ("stored", _L), ("error", _S),
            ("started_at", _S), ("finished_at", _S),
        ),
        [],
    ),
    "removed": (_schema(("what", _S), ("key", _S)), []),
    "staged_archive": (ARCHIVE_ITEM, []),
    "staged_ranked": (_with(RANKED_ITEM, ("taken_at", _S)), []),
    "staged_days": (
        _schema(("source_id", _S), ("snapshot_date", _S), ("taken_at", _S), ("run_id", _S)), []
    ),
    "staged_targets": (
        _schema(("source_id", _S), ("url", _S), ("id", _S), ("content_path", _S)), []
    ),
}
#: Large tables that are written small. Items and snapshots are not: their rows are sorted as
#: they are read, and a denser file would give each task more of them.
DENSE = {"contents", "index", "staged_archive", "staged_ranked"}
STAGED = [name for name in TABLES if name.startswith("staged_")]

COMMIT = _schema(("version", _L), ("base", _L), ("run_id", _S), ("attempt", _S), ("kind", _S))
VALID = _schema(("attempt", _S), ("run_id", _S), ("version", _L), ("base", _L), ("kind", _S))
RUN, REBUILD = "run", "index"
#: The name under which the index is built: a later build replaces an earlier one.
INDEX_RUN = "(index)"


#: Commits in a block of an item's history.
BLOCK_COMMITS = 100


class Conflict(RuntimeError):
    """Another run was committed since this one read the store; run it again."""


def day_key(df: DataFrame):
    return F.concat_ws("/", df["source_id"], df["snapshot_date"])


@dataclass(frozen=True)
class Store:
    """Tables below one folder that all executors share.

    ``version`` pins what is read, ``without`` leaves one run out.
    """

    spark: SparkSession
    root: str
    version: int | None = None
    without: str | None = None

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> Store:
        """Open a store, creating folders that are missing."""
        store = cls(spark, root.rstrip("/"))
        for name in ["commits", *TABLES]:
            path = store._path(name)
            path.getFileSystem(store._conf()).mkdirs(path)
        return store

    def at(self, version: int) -> Store:
        """The store as it was once ``version`` was committed."""
        return replace(self, version=version)

    def _conf(self):
        return self.spark._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # --- the log ------------------------------------------------------------

    def commits(self) -> DataFrame:
        """Every commit up to the pinned version; one row a run and attempt."""
        log = self.spark.read.schema(COMMIT).json(self.path("commits"))
        log = log.where("attempt is not null")
        return log if self.version is None else log.where(F.col("version") <= self.version)

    def head(self) -> int:
        """The last version, 0 before the first commit.

        Taken from the names of the markers: one left empty by a crash makes no
        run visible, but its number is used up.
        """
        fs = self._path("commits").getFileSystem(self._conf())
        names = [s.getPath().getName() for s in fs.globStatus(self._path("commits/*.json")) or []]
        last = max((int(n.removesuffix(".json")) for n in names), default=0)
        return last if self.version is None else min(last, self.version)

    @cached_property
    def _log(self):
        """The last attempt of each run up to the pinned version, as an Arrow table.

        One short row a run. Spark's own listing of the attempts' files, of which
        each has several, is on the driver too; this is less.
        """
        last = F.max_by(F.struct("attempt", "run_id", "version", "base", "kind"), "version")
        return self.commits().groupBy("run_id").agg(last.alias("c")).select("c.*").toArrow()

    def valid(self) -> DataFrame:
        """(attempt, run_id, version, base, kind): the last attempt of each run."""
        pinned = self if self.version is not None else self.at(self.head())
        found = self.spark.createDataFrame(pinned._log, VALID)
        return found if self.without is None else found.where(F.col("run_id") != self.without)

    def index_build(self):
        """Commit of the index in use, None without one."""
        return self.valid().where(F.col("kind") == REBUILD).first()  # one run name, one row

    # --- reading --------------------------------------------------------------

    def _rows(self, name: str) -> DataFrame:
        """Rows of valid attempts with ``run_id`` and ``version``."""
        schema = _with(TABLES[name][0], ("attempt", _S))
        rows = self.spark.read.schema(schema).parquet(self.path(name))
        # The log is small beside any table; Spark prunes the attempts by it.
        return rows.join(self.valid().select("attempt", "run_id", "version"), "attempt").drop("attempt")

    def _gone(self, what: str) -> DataFrame:
        """(gone, gone_at): keys and the version before which they are dead."""
        rows = self._rows("removed").where(F.col("what") == what)
        return rows.groupBy(F.col("key").alias("gone")).agg(F.max("version").alias("gone_at"))

    def _alive(self, rows: DataFrame, what: str, key) -> DataFrame:
        gone = self._gone(what)
        dead = (key == gone["gone"]) & (rows["version"] < gone["gone_at"])
        return rows.join(gone, dead, "left_anti")

    def items(self) -> DataFrame:
        return self._rows("items")

    def contents(self, body: Column | None = None) -> DataFrame:
        """Bodies in use; ``body`` is a column made of each, in place of it.

        That column is made where the bodies lie, so they stay out of the join.
        """
        rows = self._rows("contents")
        if body is not None:
            kept = [c for c in rows.columns if c != "content"]
            # In a generator, as the join would be pushed below a projection.
            rows = rows.select(F.inline(F.array(F.struct(*kept, body))))
        return self._alive(rows, "contents", rows["content_path"])

    def body_history(self) -> DataFrame:
        """Every body that was ever stored, with its version; none is dead here."""
        return self._rows("contents")

    def content_versions(self) -> DataFrame:
        """Versions of each stored body over the commits, with the body.

        ``first_seen`` and ``last_seen`` are versions of the store; ``url`` is
        the body's path, which its item keeps for good.
        """
        held = self.body_history()
        seen = held.select(
            "source_id", F.col("content_path").alias("url"), F.col("version").alias("seen_at"),
            F.lit(0).alias("tie"), F.sha1("content").alias("content_hash"),
        )
        versions = history.content_versions(seen, F.floor(F.col("seen_at") / BLOCK_COMMITS))
        # A path is written once a commit, so the first sighting names the body.
        bodies = held.select(
            "source_id", F.col("content_path").alias("url"), F.col("version").alias("first_seen"), "content"
        )
        return versions.join(bodies, [*history.KEY, "first_seen"])

    def read_versions(self, version_no: int | None = None) -> DataFrame:
        """Bodies by their version, the latest by default."""
        versions = self.content_versions()
        if version_no is not None:
            return versions.where(F.col("version_no") == version_no)
        last = history.latest(versions).select(*history.KEY, "version_no")
        return versions.join(last, [*history.KEY, "version_no"], "left_semi")

    def updates(self) -> DataFrame:
        """Body versions that the last run brought."""
        last = self.valid().where(F.col("kind") == RUN).agg(F.max("version")).first()[0]
        runs = self.body_history().select("source_id").distinct()
        return history.updates(self.content_versions(), runs.withColumn("started_at", F.lit(last)))

    def snapshots(self) -> DataFrame:
        rows = self._rows("snapshots")
        return self._alive(rows, "snapshots", day_key(rows))

    def runs(self) -> DataFrame:
        return self._rows("runs").drop("version")

    def index(self) -> DataFrame:
        """Rows of the last build and of the runs after the state that it read."""
        build = self.index_build()
        rows = self._rows("index")
        if build is None:
            return rows.where(F.lit(False))
        own = (F.col("run_id") == INDEX_RUN) | (F.col("version") > build["base"])
        # An archive record has no day: its id stands in, no day is like it.
        day = F.when(F.col("snapshot_date").isNull(), F.col("record_id")).otherwise(day_key(rows))
        rows = rows.where(own).withColumn("day", day)
        rows = self._alive(rows, "index", rows["record_id"])
        return self._alive(rows, "snapshots", rows["day"]).select(*INDEX.names)

    def records(self, sources: DataFrame) -> DataFrame:
        """The index when there is one, the tables otherwise; same columns."""
        if self.index_build() is not None:
            return self.index().join(sources.select("source_id"), "source_id", "left_semi")
        return self.scan_records(sources)

    def scan_records(self, sources: DataFrame) -> DataFrame:
        return records_union(
            archive_records(self.items(), sources), snapshot_records(self.snapshots(), sources)
        )

    # --- writing --------------------------------------------------------------

    def begin(self, run_id: str) -> Attempt:
        """A new attempt of a run; it reads the store as it is now, without that run."""
        head = self.head()
        return Attempt(replace(self, version=head, without=run_id), head, run_id, f"a-{uuid.uuid4().hex}")

    def rebuild_index(self, sources: DataFrame) -> dict[str, int]:
        """Write the index from scratch; gives rows read and rows kept."""
        attempt = self.begin(INDEX_RUN)
        read, kept = Observation("read"), Observation("kept")
        records = attempt.base.scan_records(sources).observe(read, F.count(F.lit(1)).alias("n"))
        rows = merge.index_rows(records).observe(kept, F.count(F.lit(1)).alias("n"))
        attempt.write("index", rows)
        attempt.commit(REBUILD)
        return {"records": read.get["n"], "indexed": kept.get["n"]}

    def vacuum(self, running: set[str] = frozenset()) -> int:
        """Delete attempts without a marker, but those named as running; gives their number."""
        fs = self._path("commits").getFileSystem(self._conf())
        # The log and folder names only.
        known = {r["attempt"] for r in replace(self, version=None).commits().select("attempt").collect()}
        gone = set()
        for name in TABLES:
            for status in fs.globStatus(self._path(f"{name}/attempt=*")) or []:
                attempt = status.getPath().getName().removeprefix("attempt=")
                if attempt not in known | set(running):
                    fs.delete(status.getPath(), True)
                    gone.add(attempt)
        return len(gone)


@dataclass(frozen=True)
class Attempt:
    """One try of a run: ``base`` is the store it read, its own rows are unseen yet."""

    base: Store
    head: int
    run_id: str
    name: str

    def write(self, table: str, df: DataFrame) -> None:
        """Add rows below this attempt; the hint evens out files and splits a hot source."""
        schema, keys = TABLES[table]
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
        rows = df.select(*columns).withColumn("attempt", F.lit(self.name))
        hinted = rows.hint("rebalance", *keys) if keys else rows
        writer = hinted.write.mode("append").partitionBy("attempt", *keys)
        if table in DENSE:
            writer = writer.option("compression", "zstd")
        writer.parquet(self.base.path(table))

    def read(self, table: str) -> DataFrame:
        """What this attempt wrote."""
        schema = _with(TABLES[table][0], ("attempt", _S))
        rows = self.base.spark.read.schema(schema).parquet(self.base.path(table))
        return rows.where(F.col("attempt") == self.name).drop("attempt")

    def staged(self, table: str, df: DataFrame) -> DataFrame:
        """``df`` written and read again, so that Spark plans joins by its real size."""
        self.write(table, df)
        return self.read(table)

    def stage(self, archive: DataFrame, ranked: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Write a run's flattened items once; later steps read this table."""
        return self.staged("staged_archive", archive), self.staged("staged_ranked", ranked)

    def add_items(self, incoming: DataFrame, archived_at: str, parity: bool = False) -> DataFrame:
        """Rows of new urls with their bodies; gives the stored rows.

        The attempt does not see what its run stored before, so a repeated run
        stores the same rows again.
        """
        fresh = merge.new_items(incoming, self.base.items(), dedup=not parity)
        rows = merge.as_manifest_rows(fresh, archived_at)
        # Without batch duplicates every path is written once.
        order = merge.arrival(rows)
        written = merge.last_per_key(rows, ["content_path"], order) if parity else rows
        bodies = written.select(
            "content_path", F.col("id").alias("item_id"), F.col("body").alias("content"),
            merge.is_stale(F.col("body")).alias("stale"), F.lit(False).alias("refreshed"), "source_id",
        )
        self.write("contents", bodies)
        self.write("items", rows)
        return self.read("items")

    def refresh_contents(self, incoming: DataFrame) -> None:
        """Add bodies of known urls whose stored one is empty or a placeholder."""
        # The stored verdict is read, not the bodies.
        held = self.base.contents().select("content_path", "stale")
        targets = self.staged("staged_targets", merge.refresh_targets(self.base.items(), held))
        found = merge.refreshed(incoming, targets)
        self.write(
            "contents",
            found.select(
                "content_path", "item_id", F.col("body").alias("content"),
                merge.is_stale(F.col("body")).alias("stale"), F.lit(True).alias("refreshed"), "source_id",
            ),
        )
        self.remove("contents", self.read("contents").where("refreshed").select("content_path"))

    def write_snapshots(self, ranked: DataFrame) -> None:
        """The snapshot of each source and day: that of the day's last run.

        ``taken_at`` is the time of a row's run. A day that the store holds from
        a later run stays, so runs may arrive in any order.
        """
        day = ["source_id", "snapshot_date"]
        dated = ranked.withColumn("snapshot_date", F.substring("taken_at", 1, 10))
        # One row per source and day on both sides.
        last = dated.groupBy(*day).agg(F.max(F.struct("taken_at", "run_id")).alias("last"))
        held = self.base.snapshots().groupBy(*day).agg(F.max("taken_at").alias("held"))
        wanted = last.join(held, day, "left").where("held is null or last.taken_at >= held")
        wanted = self.staged("staged_days", wanted.select(*day, "last.taken_at", "last.run_id"))
        self.write("snapshots", dated.join(wanted, [*day, "taken_at", "run_id"], "left_semi"))
        self.remove("snapshots", wanted.select(F.concat_ws("/", *day)))

    def remove(self, what: str, keys: DataFrame) -> None:
        """Take keys (one column) back from all versions before this one."""
        self.write("removed", keys.toDF("key").withColumn("what", F.lit(what)))

    def upsert_index(self, sources: DataFrame) -> None:
        """Index what this attempt stored; on equal record ids the new row wins."""
        own = records_union(
            archive_records(self.read("items"), sources),
            snapshot_records(self.read("snapshots"), sources),
        )
        self.write("index", merge.index_rows(own))
        self.remove("index", self.read("index").select("record_id"))

    def record_run(self, report: DataFrame, started_at: str, finished_at: str) -> None:
        stamps = {"started_at": F.lit(started_at), "finished_at": F.lit(finished_at)}
        self.write("runs", report.withColumns(stamps))

    def commit(self, kind: str = RUN) -> int:
        """Make the attempt visible; gives its version.

        A run fails if another was committed since it began. A build of the
        index doesn't: runs after the state it read stay in the index.
        """
        version = self.head + 1
        while not self._marked(version, kind):
            if kind == RUN:
                raise Conflict(f"version {version} was committed while {self.run_id} ran")
            version += 1
        for name in STAGED:
            path = self.base._path(f"{name}/attempt={self.name}")
            path.getFileSystem(self.base._conf()).delete(path, True)
        return version

    def _marked(self, version: int, kind: str) -> bool:
        path = self.base._path(f"commits/{version:012d}.json")
        fs = path.getFileSystem(self.base._conf())
        row = {"version": version, "base": self.head, "run_id": self.run_id,
               "attempt": self.name, "kind": kind}
        try:
            out = fs.create(path, False)  # fails if the version is taken
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        out.write(bytearray(json.dumps(row), "utf-8"))
        out.close()
        return True
