"""Warehouse tables on plain Parquet: full-refresh tables and the upserted fact.

Data files are immutable. A write goes to a folder of its own and becomes
visible with its one-row commit record, written last; what a job that died left
behind is named by no record. Readers take the newest commit, or for time travel
the newest one at or before a timestamp.

* ``ReplaceTable``: every commit is a complete copy.
* ``FactTable``: keyed upsert. A merge rewrites the date partitions it touches,
  those of the source rows and those a matched target row leaves; the others
  stay where earlier commits wrote them. Rows go to their partitions' files without
  a shuffle unless that would make many small ones. Reading is one scan of the live
  partitions' folders.

One writer at a time, as the daily batch runs; merging a source again gives the
same rows, so a replay needs no guard.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import DuplicateSourceKey, upsert
from ..session import drop_dir, fresh_dir
from ..sources.contracts import FACT_COLUMNS, FACT_KEY, FACT_PARTITION, FACT_SCHEMA, Sort

RECORD_SCHEMA = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("commit_ts", T.TimestampType()),
    T.StructField("folder", T.StringType()),
    T.StructField("touched", T.ArrayType(T.StringType())),
    T.StructField("emptied", T.ArrayType(T.StringType())),
    T.StructField("columns", T.StringType()),
])
#: Bytes of keys (with what a hash table adds a row) up to which a merge sends its keys to the target's tasks.
SMALL_KEYS, ROW_BYTES = 128 << 20, 64
#: A merge writes unshuffled what one task can (rows), or where files hold this many rows on average; tasks get more than the third,
#: and up to the fourth where every core has such a task.
TASK_ROWS, FILE_ROWS, LEAST_ROWS, MOST_ROWS = 500_000, 20_000, 250_000, 2_000_000


def _fits(rows: int, chars: int | None, columns: int = 1) -> bool:
    """Whether so many rows of keys of ``chars`` characters in all may go to every task."""
    return rows * ROW_BYTES * columns + (chars or 0) <= SMALL_KEYS


def as_utc(at) -> _dt.datetime:
    """A timestamp argument in UTC: a date (its midnight), a datetime, or their ISO text, with or without a zone."""
    if isinstance(at, str):
        at = _dt.datetime.fromisoformat(at.strip())
    elif not isinstance(at, _dt.datetime):
        at = _dt.datetime(at.year, at.month, at.day)
    return at.replace(tzinfo=_dt.timezone.utc) if at.tzinfo is None else at.astimezone(_dt.timezone.utc)


@dataclass(frozen=True)
class Commit:
    version: int
    commit_ts: _dt.datetime
    folder: str
    touched: tuple[str, ...] = ()
    emptied: tuple[str, ...] = ()
    columns: str | None = None


@dataclass
class Group:
    """Partitions of a target with the rows in them that met a key, the characters of those keys, and whether they may be sent."""

    rows: dict[str, int]
    chars: int
    fits: bool

    @property
    def parts(self) -> set[str]:
        return set(self.rows)

    def without(self, parts: set[str]) -> Group:
        return Group({p: n for p, n in self.rows.items() if p not in parts}, self.chars, self.fits)


class _Committed:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    @property
    def data(self) -> str:
        return f"{self.path}/data"

    def commits(self) -> list[Commit]:
        """All commits, oldest first (one small record a batch)."""
        try:
            rows = self.spark.read.schema(RECORD_SCHEMA).json(f"{self.path}/_commits").select(
                "version", F.unix_micros("commit_ts").alias("micros"), "folder", "touched", "emptied", "columns").collect()
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        epoch = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)
        return sorted((Commit(r.version, epoch + _dt.timedelta(microseconds=r.micros), r.folder,
                              tuple(r.touched or ()), tuple(r.emptied or ()), r.columns) for r in rows), key=lambda c: c.version)

    def _upto(self, at) -> list[Commit]:
        commits = self.commits()
        return commits if at is None else [c for c in commits if c.commit_ts <= as_utc(at)]

    def exists(self) -> bool:
        return bool(self.commits())

    def _next(self, commits: list[Commit], commit_ts) -> tuple[int, _dt.datetime]:
        """Number and time of a new commit; commit times never go back."""
        ts = _dt.datetime.now(_dt.timezone.utc) if commit_ts is None else as_utc(commit_ts)
        if commits and ts < commits[-1].commit_ts:
            raise ValueError(f"commit time {ts} is before the last commit's {commits[-1].commit_ts}")
        return (commits[-1].version + 1 if commits else 1), ts

    def _record(self, version: int, ts: _dt.datetime, folder: str, touched=(), emptied=(), columns=None) -> None:
        names = lambda parts: F.array(*map(F.lit, parts)).cast("array<string>")
        values = (F.lit(version), F.lit(ts.isoformat()).cast("timestamp"), F.lit(folder), names(touched), names(emptied),
                  F.lit(columns).cast("string"))
        (self.spark.range(1).select(*[v.alias(f.name) for v, f in zip(values, RECORD_SCHEMA)]).coalesce(1)
         .write.mode("errorifexists").json(f"{self.path}/_commits/v={version:06d}"))


class ReplaceTable(_Committed):
    """Full refresh: ``replace(df)`` writes a complete new copy. The record holds its schema, so reading infers none."""

    def replace(self, df: DataFrame, commit_ts=None) -> None:
        version, ts = self._next(self.commits(), commit_ts)
        folder = f"v{version:06d}-{uuid.uuid4().hex[:8]}"
        df.write.mode("errorifexists").parquet(f"{self.data}/{folder}")
        self._record(version, ts, folder, columns=df.schema.json())

    def live(self, at=None) -> tuple[str, T.StructType]:
        """Folder and schema of the newest copy, or of the one as of ``at``."""
        commits = self._upto(at)
        if not commits:
            raise LookupError(f"table {self.path} has no version" + ("" if at is None else f" at {at}"))
        return f"{self.data}/{commits[-1].folder}", T.StructType.fromJson(json.loads(commits[-1].columns))

    def read(self, at=None) -> DataFrame:
        folder, schema = self.live(at)
        return self.spark.read.schema(schema).parquet(folder)


def _ahead(c: Sort, a, b):
    """Whether value ``a`` sorts before ``b``, as in an ORDER BY of this entry."""
    low, high = (b, a) if c.descending else (a, b)
    null_first = a.isNull() if not c.nulls_go_last else b.isNull()
    null_other = b.isNull() if not c.nulls_go_last else a.isNull()
    return F.when(a.isNull() & b.isNull(), False).when(null_first, True).when(null_other, False).otherwise(low < high)


def precedes(order: Sequence[Sort], a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    """Whether row ``a`` comes strictly before row ``b`` under ``order``."""
    out = F.lit(False)
    for c in reversed(order):
        x, y = a(c.column), b(c.column)
        out = _ahead(c, x, y) | (x.eqNullSafe(y) & out)
    return out


class FactTable(_Committed):
    """The transaction fact. ``part_format`` is the date pattern of its partitions, days unless given.

    ``extras`` (name -> type) are further columns that are stored but not read
    back: what an ordered merge compares beyond the fact's own columns.
    """

    key = FACT_KEY

    def __init__(self, spark: SparkSession, path: str, part_format: str = "yyyy-MM-dd",
                 extras: dict[str, str] | None = None):
        super().__init__(spark, path)
        self.part_format = part_format
        self.extras = dict(extras or {})
        self.stored = T.StructType([*FACT_SCHEMA, *(T.StructField(c, T.DataType.fromDDL(t))
                                                    for c, t in self.extras.items())])

    def _part(self):
        return F.coalesce(F.date_format(FACT_PARTITION, self.part_format), F.lit("none"))

    def live(self, at=None) -> dict[str, str]:
        """Partition -> folder of its current rows, or of those as of ``at``."""
        return self._live(self._upto(at))

    def _live(self, commits: list[Commit]) -> dict[str, str]:
        owner = {}
        for c in commits:
            for part in c.touched:
                owner[part] = c.folder
            for part in c.emptied:
                del owner[part]
        return {part: f"{self.data}/written_by={folder}/part={quote(part, safe=' ,;@!&()+~$-_.')}"
                for part, folder in owner.items()}

    def _scan(self, commits: list[Commit], only: set[str] | None = None) -> DataFrame:
        """The stored rows of ``commits`` with their partition column, of the partitions ``only`` if given.

        Only the folders of live partitions are listed, however often they were written before.
        """
        schema = T.StructType([*self.stored, T.StructField("part", T.StringType())])
        paths = [path for part, path in self._live(commits).items() if only is None or part in only]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.data).parquet(*paths).select(*schema.names)

    def read(self, at=None) -> DataFrame:
        """Current rows, or the rows as of timestamp ``at`` (empty before the first commit)."""
        return self._scan(self._upto(at)).select(*FACT_COLUMNS)

    def matches(self, target: DataFrame, keys: DataFrame, small: bool, order: Sequence[Sort] = ()) -> DataFrame:
        """(key, was, stays) of the target rows whose key is among ``keys``.

        A small set of keys goes to the target's tasks, so no key of the target
        is shuffled; ``stays`` is whether the target row precedes its source row.
        """
        renamed = keys.select(*[F.col(c).alias(f"new_{c}") for c in keys.columns])
        if small:
            renamed = F.broadcast(renamed)
        stays = precedes(order, F.col, lambda c: F.col(f"new_{c}"))
        columns = [self.key, "part", *(s.column for s in order)]
        return (target.select(*dict.fromkeys(columns)).join(renamed, F.col(self.key) == F.col(f"new_{self.key}"))
                .select(self.key, F.col("part").alias("was"), stays.alias("stays")))

    def merge(self, source: DataFrame, commit_ts=None, order: Sequence[Sort] = ()) -> None:
        """Upsert ``source`` on the key: matched rows are replaced, others inserted. A key that repeats is an error.

        With ``order`` a matched row is replaced only by one that does not come
        after it, so the table does not depend on how rows are dealt over merges. Null
        keys match nothing and are inserted. The source is read for its keys and
        partitions, which are stored, for what an order compares, and for its rows.
        """
        missing = [c for c in self.extras if c not in source.columns]
        source = source.select(*FACT_COLUMNS, *[c for c in self.extras if c not in missing],
                               *[F.lit(None).cast(self.extras[c]).alias(c) for c in missing])
        source = source.select(*self.stored.names).withColumn("part", self._part())
        commits = self.commits()
        version, ts = self._next(commits, commit_ts)
        work = fresh_dir(self.spark, "merge")
        folder = f"v{version:06d}-{uuid.uuid4().hex[:8]}"
        path = f"{self.data}/written_by={folder}"
        try:
            touched = self._rewrite(source, commits, order, work, path)
        finally:
            drop_dir(self.spark, work)
        if not touched:
            return
        schema = T.StructType([T.StructField("part", T.StringType())])
        filled = {r[0] for r in self.spark.read.schema(schema).parquet(path).distinct().collect()}
        self._record(version, ts, folder, sorted(touched), sorted(touched - filled))

    def _rewrite(self, source: DataFrame, commits: list[Commit], order: Sequence[Sort], work: str, path: str) -> set[str]:
        """Write the partitions the merge touches, as they are after it; their names."""
        live = self._live(commits)
        names = list(dict.fromkeys([self.key, *(s.column for s in order)]))
        keys = self._stored(source.select(self.key, "part"), "keys", work)
        counted = keys.where(F.col(self.key).isNotNull()).groupBy(self.key).count()
        size = counted.agg(F.max("count"), F.max_by(self.key, "count"), F.count("*"), F.sum(F.length(self.key))).first()
        if (size[0] or 0) > 1:
            raise DuplicateSourceKey(f"upsert source repeats {self.key}={size[1]!r} ({size[0]} rows)")
        groups = []
        if live:
            small = _fits(size[2], size[3], len(names))
            met = self._met(source.select(*names), keys.select(self.key), commits, small, order, work)
            moved = met.where("NOT stays")
            groups = self._groups(moved)
            if order:
                stay = met.where("stays").select(self.key)
                if _fits(*stay.agg(F.count("*"), F.sum(F.length(self.key))).first()):
                    stay = F.broadcast(stay)
                keys, source = (df.join(stay, self.key, "left_anti").select(*df.columns) for df in (keys, source))
        # names of partitions only, each set once
        filling = dict(map(tuple, keys.groupBy("part").count().collect()))
        left = set().union(*(g.parts for g in groups))
        touched = left | set(filling)
        if not touched:
            return touched
        if len(groups) > 1:
            # of a partition whose rows are all replaced none is kept, so it is not read
            held = dict(map(tuple, self._scan(commits, left).groupBy("part").count().collect()))
            groups = [g for g in (g.without({p for p in g.parts if held.get(p) == g.rows[p]}) for g in groups) if g.rows]
        writes = []
        for g in groups:
            # kept rows lie by partition already; only a shuffled join deals them anew
            gone = moved.where(F.col("was").isin(*sorted(g.parts)))
            kept = upsert(self._scan(commits, g.parts), source.limit(0), self.key,
                          matched=F.broadcast(gone) if g.fits else gone)
            writes.append(kept if g.fits else kept.hint("rebalance", "part"))
        rows = self._dealt(source, sum(filling.values()), len(filling))
        if same := touched & set(live) - left:
            rows = self._scan(commits, same).unionByName(rows)
        # keys sent to the tasks are those of one write at a time
        writes = [writes[0].unionByName(rows)] if len(writes) == 1 else [*writes, rows]
        for one in writes:
            one.write.mode("append").partitionBy("part").parquet(path)
        return touched

    def _met(self, asked: DataFrame, keys: DataFrame, commits: list[Commit], small: bool, order: Sequence[Sort],
             work: str) -> DataFrame:
        """The matches of the source rows ``asked`` (key and what ``order`` names), stored.

        Where their keys are too many to send, bare keys are shuffled to find those in both; what an order
        compares is then read of these only, as many of the target's partitions at a time as their keys fit.
        """
        if small or not order:
            return self._stored(self.matches(self._scan(commits), asked if order else keys, small, order), "matches", work)
        common = self._stored(self.matches(self._scan(commits), keys, False), "common", work)
        groups = self._groups(common)
        for g in groups:
            mine = common.where(F.col("was").isin(*sorted(g.parts))).select(self.key)
            both = (df.join(F.broadcast(mine) if g.fits else mine, self.key, "left_semi")
                    for df in (self._scan(commits, g.parts), asked))
            self.matches(*both, False, order).write.mode("append").parquet(f"{work}/matches")
        return self.spark.read.schema(common.schema).parquet(f"{work}/matches") if groups else common

    def _groups(self, met: DataFrame) -> list[Group]:
        """The target's partitions by the keys that met there: as many together as can be sent, else one by itself."""
        out: list[Group] = []
        for part, rows, chars in sorted(map(tuple, met.groupBy("was").agg(F.count("*"), F.sum(F.length(self.key))).collect())):
            if out and _fits(sum(out[-1].rows.values()) + rows, out[-1].chars + chars):
                out[-1].rows[part] = rows
                out[-1].chars += chars
            else:
                out.append(Group({part: rows}, chars, _fits(rows, chars)))
        return out

    def _dealt(self, source: DataFrame, rows: int, parts: int) -> DataFrame:
        """``source`` as its tasks write it: unshuffled where that leaves files of ``FILE_ROWS`` rows, or one a partition.

        Else REBALANCE packs small partitions together and splits a hot one over several tasks.
        """
        each = max(parts * FILE_ROWS, LEAST_ROWS)
        busy = each <= MOST_ROWS and rows // each >= self.spark.sparkContext.defaultParallelism
        if rows <= TASK_ROWS or each <= TASK_ROWS or busy:
            return source.coalesce(max(1, rows // each))
        return source.hint("rebalance", "part")

    def _stored(self, df: DataFrame, purpose: str, work: str | None = None) -> DataFrame:
        path = f"{work}/{purpose}" if work else fresh_dir(self.spark, purpose)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
