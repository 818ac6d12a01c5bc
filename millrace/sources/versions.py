"""Tables whose loads show all at once or not at all.

A versioned table is a folder with data folders, which never change once written, and a log:
``_log/00000000000000000007.json`` names the data folders that make up version 7, and carries
whatever facts the load wants to keep with them. A load writes its data folder, may
audit it, and then publishes: the commit file is written aside and renamed to the next number,
which fails if another load has taken it. Readers follow the newest commit. So a load that dies,
or whose audit fails, leaves the old rows readable, and a table without partitions can be
replaced or upserted as a whole.

The rename must not overwrite, which HDFS and local file systems guarantee. On object stores
two writers at the same moment need a lock of their own; readers are safe there too.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.keys import latest_per_key, numbered
from millrace.session import scratch, stored
from millrace.sources.files import FileStore, empty_frame

Audit = Callable[[DataFrame], None]


class CommitConflict(RuntimeError):
    """Another load has published since this one read the table."""


@dataclass(frozen=True)
class Version:
    number: int = 0  # 0: nothing published yet
    folders: tuple[str, ...] = ()
    facts: dict = field(default_factory=dict)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.files = FileStore(spark)

    def current(self) -> Version:
        commits = [n for n in self.files.names(f"{self.path}/_log") if n.endswith(".json")]
        if not commits:
            return Version()
        commit = json.loads(self.files.read(f"{self.path}/_log/{commits[-1]}"))
        return Version(int(commits[-1].split(".")[0]), tuple(commit["folders"]), commit["facts"])

    def read(self, version: Version | None = None) -> DataFrame:
        """The rows of a version; by default the newest one."""
        version = version or self.current()
        if not version.folders:
            return empty_frame(self.spark, self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in version.folders])

    def replace(self, rows: DataFrame, audit: Audit | None = None, **facts) -> Version:
        """All rows anew. `audit` sees the written rows and raises if they must not show."""
        return self._publish(rows, self.current(), keep=False, audit=audit, facts=facts)

    def append(self, rows: DataFrame, audit: Audit | None = None, **facts) -> Version:
        return self._publish(rows, self.current(), keep=True, audit=audit, facts=facts)

    def upsert(self, batch: DataFrame, keys: Sequence[str], version: Sequence[str], audit: Audit | None = None) -> Version:
        """Insert or replace by key; the highest `version` columns win, the batch wins a tie."""
        base = self.current()
        both = self.read(base).withColumn("from_batch", F.lit(False)).unionByName(batch.withColumn("from_batch", F.lit(True)))
        newest = latest_per_key(both, keys, [*version, "from_batch"]).drop("from_batch")
        return self._publish(newest, base, keep=False, audit=audit, facts=base.facts)

    def append_numbered(self, batch: DataFrame, natural_key: Sequence[str], number: str) -> Version:
        """Append the rows whose natural key is new, numbered on from the last number given out.

        Numbers follow the order of the natural key and have no gaps. The last one is published
        with the rows, so a load that failed gave none out, and its retry gives the same.
        A key that the batch repeats is numbered once; of its rows the first by the other columns stays.
        """
        base = self.current()
        last = int(base.facts.get(f"last_{number}", 0))
        rest = [c for c in self.schema.names if c not in (*natural_key, number)]
        fresh = batch.groupBy(*natural_key).agg(*([F.min(F.struct(*rest)).alias("row")] if rest else []))
        fresh = fresh.select(*natural_key, *[F.col(f"row.{c}").alias(c) for c in rest])
        seen = self.read(base).select(*[F.col(k).alias(f"known_{k}") for k in natural_key])
        same = [F.col(k).eqNullSafe(F.col(f"known_{k}")) for k in natural_key]
        fresh = fresh.join(seen, same, "left_anti")
        with scratch(self.spark, "numbered") as folder:
            rows = numbered(fresh, natural_key, number, folder, after=last)
            kind = self.schema[number].dataType
            rows = stored(rows.withColumn(number, F.col(number).cast(kind)).select(*self.schema.names), f"{folder}/rows")
            last = rows.agg(F.max(number)).first()[0] or last
            return self._publish(rows, base, keep=True, audit=None, facts={**base.facts, f"last_{number}": int(last)})

    def _publish(self, rows: DataFrame, base: Version, *, keep: bool, audit: Audit | None, facts: dict) -> Version:
        folder = f"data-{uuid.uuid4().hex}"
        place = f"{self.path}/{folder}"
        try:
            rows.select(*self.schema.names).write.parquet(place)
            if audit:
                audit(self.spark.read.schema(self.schema).parquet(place))
            version = Version(base.number + 1, (*(base.folders if keep else ()), folder), facts)
            self.commit(version)
        except BaseException:
            self.files.delete(place)
            raise
        return version

    def commit(self, version: Version) -> None:
        """Publish a version whose data folders are complete; fails if its number is taken."""
        aside = f"{self.path}/_log/.{uuid.uuid4().hex}"
        self.files.write(aside, json.dumps({"folders": version.folders, "facts": version.facts}))
        if not self.files.rename(aside, f"{self.path}/_log/{version.number:020d}.json"):
            self.files.delete(aside)
            raise CommitConflict(f"version {version.number} of {self.path} is already there")

    def vacuum(self, versions: int = 2) -> int:
        """Remove commits but the newest `versions`, and data folders that none of these names; returns how many folders went.

        Not to be called while another load writes: its folder is not in the log yet.
        """
        commits = [n for n in self.files.names(f"{self.path}/_log") if n.endswith(".json")]
        named = {f for n in commits[-versions:] for f in json.loads(self.files.read(f"{self.path}/_log/{n}"))["folders"]}
        for name in commits[:-versions]:
            self.files.delete(f"{self.path}/_log/{name}")
        gone = [n for n in self.files.names(self.path) if n.startswith("data-") and n not in named]
        for name in gone:
            self.files.delete(f"{self.path}/{name}")
        return len(gone)


class RunLedger:
    """Which runs of which tables are done, from which source, with how many rows.

    One small file per (table, run), replaced in one step. A record says `open` while the
    run is under way, so an interrupted run is found again; and it holds the version of the
    source that was read, so a run whose source has changed is open too. Whether a run is
    finished is seen here without reading any table.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), FileStore(spark)

    def record(self, table: str, run: str) -> dict | None:
        if f"{run}.json" not in self.files.names(f"{self.path}/{table}"):
            return None
        return json.loads(self.files.read(f"{self.path}/{table}/{run}.json"))

    def _set(self, table: str, run: str, **record) -> None:
        aside = f"{self.path}/{table}/.{uuid.uuid4().hex}"
        self.files.write(aside, json.dumps(record))
        self.files.rename(aside, f"{self.path}/{table}/{run}.json", overwrite=True)

    def is_done(self, table: str, run: str, source: str) -> bool:
        found = self.record(table, run)
        return bool(found) and found["state"] == "done" and found["source"] == source

    def perform(self, table: str, run: str, source: str, load: Callable[[], int]) -> bool:
        """Do a run that is not done yet; `load` returns its rows. False if there was nothing to do."""
        if self.is_done(table, run, source):
            return False
        self._set(table, run, state="open", source=source, rows=None)
        self._set(table, run, state="done", source=source, rows=load())
        return True

    def reopen(self, table: str, run: str) -> None:
        """The run is to be done again, whatever its source."""
        if found := self.record(table, run):
            self._set(table, run, **{**found, "state": "open"})

    def records(self) -> DataFrame:
        """(table, run, state, source, rows) of all runs."""
        runs = [(t, n[:-5]) for t in self.files.names(self.path) for n in self.files.names(f"{self.path}/{t}") if n.endswith(".json")]
        rows = [(t, r, *(self.record(t, r)[k] for k in ("state", "source", "rows"))) for t, r in runs]
        return self.spark.createDataFrame(rows, "table string, run string, state string, source string, rows long")

    def open_runs(self, table: str, sources: dict[str, str]) -> list[str]:
        """Of the runs that there are sources for (run: version of its source), those that are not done."""
        return sorted(run for run, source in sources.items() if not self.is_done(table, run, source))
