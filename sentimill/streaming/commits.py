"""The commit log of a stored history: what readers see, and when.

A batch writes its tables first and then one small record that names their folders and row
counts.  Readers go by the records alone, so a batch is seen whole or not at all, and
"the newest n batches of a table" are the newest that have rows in that table.

    <history>/_log/batch/<epoch>.<date>.json            a committed batch
    <history>/_log/day/<date>.<version>.json            the compacted batches of a day, up to an epoch
    <history>/_log/floor/<table>.<version>.json         the oldest batch that retention leaves visible
    <history>/<table>/batch_date=<date>/...             folders that records name

Every change is one file that is written aside and renamed into place:

* ``compact`` merges a day's batches (and what the day had before) into one file set per table, and the new
  version of the day's record replaces all of them at once: a reader sees the state before or the one after.
* ``retain`` raises a table's floor; batches below are invisible from then on.
* ``vacuum`` deletes what no reader can see any more.  ``compact`` and ``retain`` begin with it, so files
  outlive their last visibility by one run, which is what readers have to finish.

A crash between two steps leaves files that nothing names; the next run's ``vacuum`` finds the superseded ones.
One writer at a time: the stream, whose epochs ascend.  The driver handles names and a line per batch not yet compacted.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_FILE = 5_000_000
LOG_SCHEMA = "batch_id bigint, batch_start timestamp_ntz, name string, rows bigint"
RECORD_SCHEMA = ("batch_id bigint, batch_start timestamp_ntz, query string, "
                 "parts array<struct<name: string, path: string, rows: bigint>>")


class Part(NamedTuple):
    """Rows of one batch in one table."""
    batch_id: int
    batch_start: dt.datetime
    path: str


class Day(NamedTuple):
    """The compacted batches of a date."""
    date: str
    version: int
    through: int                    # batches of this date up to this epoch are in it
    query: str | None
    log: str                        # folder of its lines: LOG_SCHEMA
    tables: dict                    # name: {path, first, last: the first and last (start, id) that have rows}


class CommitLog:
    def __init__(self, spark: SparkSession, out_dir: str):
        self.spark = spark
        self.out_dir = out_dir.rstrip("/")
        self.root = f"{self.out_dir}/_log"

    # ---- files -------------------------------------------------------------------

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.out_dir).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs(), self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _put(self, name: str, value: dict) -> None:
        """Write a record aside and rename it into place."""
        fs, aside, path = self._fs(), self._path(f"{self.root}/aside/{uuid.uuid4().hex}"), self._path(f"{self.root}/{name}")
        out = fs.create(aside)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        fs.mkdirs(path.getParent())
        if not fs.rename(aside, path):
            raise RuntimeError(f"could not write {path}")

    def _get(self, name: str) -> dict:
        return json.loads(self.spark.read.text(f"{self.root}/{name}", wholetext=True).first()[0])

    def delete(self, path: str) -> None:
        self._fs().delete(self._path(path), True)

    # ---- state -------------------------------------------------------------------

    def _days(self) -> dict[str, Day]:
        """The newest version of each day's record."""
        newest: dict[str, int] = {}
        for name in self._names("day"):
            date, version, _ = name.split(".")
            newest[date] = max(newest.get(date, 0), int(version))
        return {date: self._day(date, version) for date, version in newest.items()}

    def _day(self, date: str, version: int) -> Day:
        found = self._get(f"day/{date}.{version:010d}.json")
        return Day(date, version, found["through"], found["query"], found["log"], found["tables"])

    def _state(self) -> tuple[list[str], dict[str, Day]]:
        """(names of the batch records that no day covers, ascending; days).  Records are listed before days, so
        a batch that is compacted in between is found in either."""
        names = self._names("batch")
        days = self._days()
        return [n for n in names if not self._covered(n, days)], days

    @staticmethod
    def _covered(name: str, days: dict[str, Day]) -> bool:
        epoch, date, _ = name.split(".")
        return date in days and int(epoch) <= days[date].through

    def _records(self, names: list[str]) -> DataFrame:
        """(batch_id, batch_start, query, name, path, rows) of some batch records."""
        if not names:
            return self.spark.createDataFrame([], "batch_id bigint, batch_start timestamp_ntz, query string, name string, path string, rows bigint")
        rows = self.spark.read.schema(RECORD_SCHEMA).json([f"{self.root}/batch/{n}" for n in names])
        return rows.select("batch_id", "batch_start", "query", F.inline("parts"))

    @staticmethod
    def _visible(rows: DataFrame, floors: dict) -> DataFrame:
        """Lines (name, batch_start, batch_id, rows) of batches that have rows and are not below their table's floor."""
        rows = rows.filter("rows > 0")
        for table, floor in floors.items():
            rows = rows.filter((F.col("name") != table) | _from(floor))
        return rows

    def _floors(self) -> dict[str, tuple[dt.datetime, int]]:
        newest: dict[str, str] = {}
        for name in self._names("floor"):                                    # ascending versions
            newest[name.split(".")[0]] = name
        found = {table: self._get(f"floor/{name}") for table, name in newest.items()}
        return {table: (dt.datetime.fromisoformat(f["batch_start"]), f["batch_id"]) for table, f in found.items()}

    # ---- writing -----------------------------------------------------------------

    def committed(self, epoch: int, query: str | None = None) -> bool:
        """Whether an epoch is in the history.  Raises if another query put it there."""
        own = [n for n in self._names("batch") if int(n.split(".")[0]) == epoch]
        if own:
            found = self._get(f"batch/{own[0]}")["query"]
        else:
            days = [d for d in self._days().values() if d.through >= epoch]
            if not days:
                return False
            found = min(days, key=lambda d: d.through).query
        if found and query and found != query:
            raise ValueError(f"epoch {epoch} of {self.out_dir} was written by another query: use its checkpoint, or another folder")
        return True

    def commit(self, epoch: int, start: dt.datetime, parts: dict[str, tuple[str, int]], query: str | None = None) -> None:
        """Make a batch visible: ``parts`` has folder (under the history) and rows of each table that has rows."""
        self._put(f"batch/{epoch:020d}.{start.date()}.json", {
            "batch_id": epoch, "batch_start": start.isoformat(), "query": query,
            "parts": [{"name": table, "path": path, "rows": rows} for table, (path, rows) in parts.items()]})

    # ---- reading -----------------------------------------------------------------

    def batches(self) -> DataFrame:
        """(batch_start, batch_id) of every batch."""
        names, days = self._state()
        rows = self._records(names).select("batch_start", "batch_id")
        if days:
            rows = rows.unionByName(self.spark.read.schema(LOG_SCHEMA).parquet(
                *[f"{self.out_dir}/{d.log}" for d in days.values()]).select("batch_start", "batch_id"))
        return rows.distinct()

    def newest(self, table: str, n: int) -> list[Part]:
        """The newest n batches that have rows in ``table``, the newest first.

        Looked for among the newest records and days only, twice as many each time.
        """
        names, days = self._state()
        floor = self._floors().get(table)
        found: list[Part] = []
        ahead, take = list(reversed(names)), 2 * n
        while ahead and len(found) < n:
            some, ahead, take = ahead[:take], ahead[take:], take * 2
            own = self._records(some).filter((F.col("name") == table) & (F.col("rows") > 0))
            found += [Part(r["batch_id"], r["batch_start"], r["path"]) for r in _last(own, n - len(found)).collect()]
        for day in sorted(days.values(), key=lambda d: d.date, reverse=True):
            if len(found) >= n:
                break
            if table in day.tables:
                own = self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.out_dir}/{day.log}").filter(F.col("name") == table)
                found += [Part(r["batch_id"], r["batch_start"], day.tables[table]["path"]) for r in _last(own, n - len(found)).collect()]
        return [p for p in found if floor is None or (p.batch_start, p.batch_id) >= floor]

    def read(self, table: str, schema: str, parts: list[Part] | None = None) -> DataFrame:
        """Rows of some batches of a table (of all, if not said): only the folders that hold them are listed."""
        if parts is not None:
            paths, floor = sorted({p.path for p in parts}), None
        else:
            names, days = self._state()
            floor = self._floors().get(table)
            records = self._visible(self._records(names), {table: floor} if floor else {})
            paths = [r["path"] for r in records.filter(F.col("name") == table).select("path").collect()]
            paths += [d.tables[table]["path"] for d in days.values() if table in d.tables and not _below(d.tables[table]["last"], floor)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*[f"{self.out_dir}/{p}" for p in paths])
        if parts is not None:
            return rows.filter(F.col("batch_id").isin([p.batch_id for p in parts]))
        return rows.filter(_from(floor)) if floor else rows

    # ---- maintenance -------------------------------------------------------------

    def compact(self, schemas: dict[str, str]) -> int:
        """Merge the batches not yet compacted into one file set per table and date; how many batches that were."""
        self.vacuum()
        names, days = self._state()
        floors = self._floors()
        by_date: dict[str, list[str]] = {}
        for name in names:
            by_date.setdefault(name.split(".")[1], []).append(name)
        for date, own in by_date.items():
            before = days.get(date)
            records = self._records(own)
            visible = self._visible(records, floors)
            lines = visible.select("batch_id", "batch_start", "name", "rows")
            if before:
                lines = lines.unionByName(self._visible(self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.out_dir}/{before.log}"), floors))
            tag = uuid.uuid4().hex
            log = f"_log/lines/{date}.{tag}"
            lines.coalesce(1).sortWithinPartitions("name", "batch_start", "batch_id").write.parquet(f"{self.out_dir}/{log}")
            folders = [(r["name"], r["path"]) for r in visible.select("name", "path").collect()]
            tables = {}
            key = F.struct("batch_start", "batch_id")
            sums = (self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.out_dir}/{log}").groupBy("name")
                    .agg(F.sum("rows").alias("rows"), F.min(key).alias("first"), F.max(key).alias("last")).collect())     # a row per table
            for r in sums:
                table = r["name"]
                paths = [p for name, p in folders if name == table]
                if before and table in before.tables and not _below(before.tables[table]["last"], floors.get(table)):
                    paths.append(before.tables[table]["path"])
                rows = self.spark.read.schema(schemas[table]).parquet(*[f"{self.out_dir}/{p}" for p in paths])
                if table in floors:
                    rows = rows.filter(_from(floors[table]))
                files = -(-r["rows"] // ROWS_PER_FILE)
                rows = rows.coalesce(1) if files == 1 else rows.repartitionByRange(files, "batch_start", "batch_id")
                path = f"{table}/batch_date={date}/day={tag}"
                rows.sortWithinPartitions("batch_start", "batch_id").write.parquet(f"{self.out_dir}/{path}")
                tables[table] = {"path": path, **{end: [r[end]["batch_start"].isoformat(), r[end]["batch_id"]] for end in ("first", "last")}}
            query = records.agg(F.max("query")).first()[0]
            self._put(f"day/{date}.{before.version + 1 if before else 1:010d}.json", {
                "through": max(int(n.split(".")[0]) for n in own), "query": query or (before and before.query), "log": log, "tables": tables})
        return len(names)

    def retain(self, table: str, n: int) -> None:
        """Leave only the newest n batches of a table visible."""
        self.vacuum()
        kept = self.newest(table, n)
        if len(kept) == n:
            last = kept[-1]
            version = 1 + max([int(x.split(".")[1]) for x in self._names("floor") if x.split(".")[0] == table], default=0)
            self._put(f"floor/{table}.{version:010d}.json", {"batch_start": last.batch_start.isoformat(), "batch_id": last.batch_id})

    def vacuum(self) -> None:
        """Delete what no reader can see: batches that a day covers, older versions of days, rows below the floors."""
        names, days, floors = self._names("batch"), self._days(), self._floors()
        covered = [n for n in names if self._covered(n, days)]
        for r in self._records(covered).select("path").collect():
            self.delete(f"{self.out_dir}/{r['path']}")
        for name in covered:                                       # the record goes last: a crash leaves it to be found again
            self.delete(f"{self.root}/batch/{name}")
        for name in self._names("day"):
            date, version, _ = name.split(".")
            if int(version) < days[date].version:
                old = self._day(date, int(version))
                for path in [old.log, *[t["path"] for t in old.tables.values()]]:
                    self.delete(f"{self.out_dir}/{path}")
                self.delete(f"{self.root}/day/{name}")
        for table, floor in floors.items():
            for r in self._records([n for n in names if n not in set(covered)]).filter((F.col("name") == table) & ~_from(floor)).select("path").collect():
                self.delete(f"{self.out_dir}/{r['path']}")
            for day in days.values():
                if table in day.tables and _below(day.tables[table]["last"], floor):
                    self.delete(f"{self.out_dir}/{day.tables[table]['path']}")

    def drop(self) -> None:
        """Forget every batch: nothing is visible any more."""
        self.delete(self.root)


def _last(rows: DataFrame, n: int) -> DataFrame:
    return rows.orderBy(F.desc("batch_start"), F.desc("batch_id")).limit(n)


def _from(floor: tuple[dt.datetime, int]):
    """Rows of the batch ``floor`` and later ones."""
    start = F.lit(floor[0]).cast("timestamp_ntz")
    return (F.col("batch_start") > start) | ((F.col("batch_start") == start) & (F.col("batch_id") >= floor[1]))


def _below(last: list, floor: tuple[dt.datetime, int] | None) -> bool:
    return floor is not None and (dt.datetime.fromisoformat(last[0]), last[1]) < floor
