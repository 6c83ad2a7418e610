"""Stored tables: Parquet files plus a small commit list, with idempotent upsert.

A commit names, per storage partition, the folders that hold it now.  Writers
only add folders and then publish the next commit, so a lost executor or a
crashed job leaves the previous state readable, and earlier states stay
available as history.  One writer per table at a time: a commit file is created
only where there is none, so a second writer of the same number fails.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agrolume.operators.dedupe import SEQ, keep_first, keep_last
from agrolume.operators.quality import REASONS, violations
from agrolume.schema import STAMP, Table

# Partition values become folder names; values that fall together share a folder.
_PART_UNSAFE = re.compile("[^0-9A-Za-z_.-]")
_EMPTY = "_empty"  # Spark would store an empty text as the null folder
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _part(value: Column) -> Column:
    safe = F.regexp_replace(F.coalesce(value.cast("string"), F.lit("null")), _PART_UNSAFE.pattern, "_")
    return F.when(safe == "", _EMPTY).otherwise(safe)


def _part_of(value) -> str:
    """``_part`` for one value on the driver."""
    return _PART_UNSAFE.sub("_", "null" if value is None else str(value)) or _EMPTY


def surrogate_id(keys: Sequence[str]) -> Column:
    """64-bit id of a natural key.  A plain hash skips nulls, so which ones are null is hashed too."""
    return F.xxhash64(*keys, *[F.col(k).isNull() for k in keys])


@dataclass
class Commit:
    version: int = 0
    written_at: str = ""
    folders: dict[str, list[str]] = field(default_factory=dict)  # partition -> write folders
    streams: dict[str, int] = field(default_factory=dict)  # id of a streaming query -> last batch applied
    runs: dict[str, str] = field(default_factory=dict)  # id of a streaming query -> its run, until that has ended
    rejects: list[str] = field(default_factory=list)  # write folders of rows that a checked load turned away


class StoredTable:
    def __init__(self, spark: SparkSession, root: str, table: Table):
        self.spark, self.root, self.table = spark, root.rstrip("/"), table
        names = {f.name for f in table.schema if isinstance(f.dataType, T.IntegerType)}
        # An integer column splits the storage under its own name, so filters on it
        # prune; anything else goes through a hidden column ``part``.
        self.split_by = table.partition if table.partition in names else "part"

    # ---- commits ----

    def _fs(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()), jpath

    def _children(self, path: str) -> list[str]:
        fs, p = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._children(f"{self.root}/commits") if n.endswith(".json")]

    def commit(self, version: int | None = None) -> Commit:
        """The given or the latest commit; an empty one before the first write.

        A writer that was lost while creating its commit file may leave it cut off:
        then the commit before it holds, and the number stays used.
        """
        if version is not None:
            return self._stored_commit(version)
        known = self.versions()
        for number in reversed(known):
            try:
                found = self._stored_commit(number)
            except ValueError:
                continue
            found.version = known[-1]
            return found
        return Commit(version=known[-1] if known else 0)

    def _stored_commit(self, version: int) -> Commit:
        fs, path = self._fs(f"{self.root}/commits/{version:08d}.json")
        stream = fs.open(path)
        try:
            java = self.spark._jvm.java.io
            return Commit(**json.loads(java.BufferedReader(java.InputStreamReader(stream, "UTF-8")).readLine() or ""))
        finally:
            stream.close()

    def _publish(self, commit: Commit) -> None:
        """Create the commit file; the file system refuses if there is one already."""
        fs, target = self._fs(f"{self.root}/commits/{commit.version:08d}.json")
        try:
            out = fs.create(target, False)
            out.write(bytearray(json.dumps(commit.__dict__).encode()))
            out.close()
        except Py4JJavaError as refused:
            raise RuntimeError(f"commit {commit.version} of {self.table.name} was published by another writer") from refused

    # ---- reading ----

    def _load(self, folders: dict[str, list[str]]) -> DataFrame:
        """Stored rows with the folder they come from (write, part)."""
        inner = f"/{self.split_by}={{}}" if self.table.partition else ""
        paths = [f"{self.root}/data/write={w}" + inner.format(p) for p, ws in folders.items() for w in ws]
        columns = self.table.schema.add("write", "string")
        if self.table.partition and self.split_by == "part":
            columns = columns.add("part", "string")
        if not paths:
            df = self.spark.createDataFrame([], columns)
        else:
            df = self.spark.read.schema(columns).option("basePath", f"{self.root}/data").parquet(*paths)
        if not self.table.partition:
            return df.withColumn("part", F.lit(""))
        if self.split_by == "part":
            return df
        return df.withColumn("part", F.coalesce(F.col(self.split_by).cast("string"), F.lit(_NULL_FOLDER)))

    def read(self, version: int | None = None, parts: list | None = None) -> DataFrame:
        """The table as of a commit, or only the storage partitions of some values
        (``parts=["2022/23"]`` for a table split by crop year): others are never listed."""
        return self.as_of(self.commit(version), parts)

    def as_of(self, commit: Commit, parts: list | None = None) -> DataFrame:
        """``read`` of a commit in hand."""
        folders = commit.folders
        if parts is not None and self.table.partition:
            wanted = {_part_of(v) for v in parts}
            folders = {p: ws for p, ws in folders.items() if p in wanted}
        return self._load(folders).select(*self.table.schema.names)

    def rejects(self) -> DataFrame:
        """The declared columns and ``reasons`` of all rows that checked loads turned away."""
        paths = [f"{self.root}/rejects/write={w}" for w in self.commit().rejects]
        columns = self.table.data_schema.add(REASONS, T.ArrayType(T.StringType()))
        return self.spark.read.schema(columns).parquet(*paths) if paths else self.spark.createDataFrame([], columns)

    def history(self) -> DataFrame:
        """One row per commit still on record."""
        rows = [(c.version, c.written_at, len(c.folders)) for c in map(self.commit, self.versions())]
        return self.spark.createDataFrame(rows, "version int, written_at string, partitions int")

    # ---- writing ----

    def _stamped(self, df: DataFrame) -> DataFrame:
        """Rows with their surrogate id and load time, unless they have them."""
        t = self.table
        if t.is_fact:
            if t.pk not in df.columns:
                df = df.withColumn(t.pk, surrogate_id(t.keys))
            if STAMP not in df.columns:
                df = df.withColumn(STAMP, F.current_timestamp().cast("timestamp_ntz"))
        return df

    def _write(self, df: DataFrame) -> str:
        """Write rows to a new folder and return its name; ids are made after the rows are dealt."""
        write, t = uuid.uuid4().hex, self.table
        # Rebalancing sizes the files by bytes: hot partitions are split, small ones merged.
        if t.partition:
            if self.split_by == "part":
                df = df.withColumn("part", _part(F.expr(t.partition)))
            df = self._stamped(df.hint("rebalance", self.split_by)).sortWithinPartitions(self.split_by, *t.sort)
            df = df.select(*t.schema.names, *([] if self.split_by in t.schema.names else [self.split_by]))
            df.write.partitionBy(self.split_by).parquet(f"{self.root}/data/write={write}")
        else:
            df = self._stamped(df.hint("rebalance")).select(*t.schema.names)
            df = df.sortWithinPartitions(*t.sort) if t.sort else df
            df.write.parquet(f"{self.root}/data/write={write}")
        return write

    def _partitions(self, write: str) -> list[str]:
        if not self.table.partition:
            return [""]
        names = self._children(f"{self.root}/data/write={write}")
        mark = f"{self.split_by}="
        return [n.removeprefix(mark) for n in names if n.startswith(mark)]

    def _next(self, old: Commit, folders, stream=None, batch_id=None, run=None, rejects: list[str] | None = None) -> None:
        streams, runs = dict(old.streams), dict(old.runs)
        if stream is not None:
            streams[stream] = batch_id
        if run is not None:
            runs[stream] = run
        rejects = old.rejects if rejects is None else rejects
        self._publish(Commit(old.version + 1, datetime.now(UTC).isoformat(), folders, streams, runs, rejects))

    def end_run(self, stream: str) -> None:
        """Forget the run of a streaming query: it has read all there was."""
        old = self.commit()
        if stream in old.runs:
            runs = {k: v for k, v in old.runs.items() if k != stream}
            self._publish(Commit(old.version + 1, datetime.now(UTC).isoformat(), old.folders, old.streams, runs, old.rejects))

    def upsert(
        self,
        batch: DataFrame,
        order=None,
        replace: bool = False,
        stream: str | None = None,
        batch_id: int | None = None,
        run: str | None = None,
        references: Mapping[str, DataFrame] | None = None,
    ) -> int:
        """Insert the batch; on an equal key the batch row wins, column by column.

        The last row per key counts (file order, or ``order``).  Columns the
        batch lacks become null.  Null keys are equal to each other.  With
        ``replace`` the previous content is dropped in the same commit.  A
        ``(stream, batch_id)`` already applied is skipped; ``run`` is recorded with it.
        Two keys with one surrogate id stop the upsert.  Returns the rows written.

        With ``references`` (dimensions by name; an empty mapping checks columns only)
        the load is checked: rows that lack a required value, hold a text over its
        length or point at no dimension row are parted from the others in the one pass
        over the batch, and ``rejects()`` shows them from the same commit on.
        """
        old, t = self.commit(), self.table
        if stream is not None and old.streams.get(stream, -1) >= batch_id:
            return 0
        # ``order`` may name columns of the batch that are not stored.
        extra = tuple(dict.fromkeys([SEQ] if order is None and SEQ in batch.columns else order or ()))
        extra = tuple(c for c in extra if c not in t.data_schema.names)
        rows, rejects, staged = t.conform(batch, extra), None, None
        if references is not None:
            rows, found, staged = self._checked(rows, references)
            rejects = (old.rejects if not replace else []) + found
        rows = keep_last(rows, t.keys, order).drop(*extra)
        new = self._write(rows)
        fresh = {p: [new] for p in self._partitions(new)}
        written = self._load(fresh)

        folders = {} if replace else dict(old.folders)
        touched = {p: folders[p] for p in fresh if p in folders}
        self._check_ids(written)
        if touched:
            outdated, whole = self._outdated(touched, written)
            for p, gone in whole.items():
                folders[p] = [w for w in folders[p] if w not in gone]
            if outdated:
                # Ids that stand for two keys have stopped the load by now.
                same = (self._key_columns(written, pk=True), F.col(t.pk) == F.col(f"_new_{t.pk}")) if self._hashed_ids() else (self._key_columns(written), self._same_key())
                rest = self._load(outdated).join(*same, "left_anti")
                kept = self._write(rest.select(*t.schema.names))
                still = set(self._partitions(kept))
                for p, gone in outdated.items():
                    folders[p] = [w for w in folders[p] if w not in gone] + ([kept] if p in still else [])
        for p, ws in fresh.items():
            folders[p] = folders.get(p, []) + ws
        self._next(old, folders, stream, batch_id, run, rejects)
        if staged:
            fs, jpath = self._fs(staged)
            fs.delete(jpath, True)
        return written.count()

    def _checked(self, rows: DataFrame, references: Mapping[str, DataFrame]) -> tuple[DataFrame, list[str], str]:
        """The rows that fit, the folders (one or none) of those that do not, the staging folder.

        The batch is judged and written once, good and bad rows apart; what follows
        reads the good ones from there.
        """
        write = uuid.uuid4().hex
        staged, bad = f"{self.root}/staged/write={write}", F.col("_bad")
        judged = violations(rows, self.table, references)
        judged.withColumn("_bad", F.size(REASONS) > 0).write.partitionBy("_bad").parquet(staged)
        stored = self.spark.read.schema(T.StructType([*judged.schema, T.StructField("_bad", T.BooleanType())])).parquet(staged)
        if not self._children(f"{staged}/_bad=true"):
            return stored.where(~bad).drop(REASONS, "_bad"), [], staged
        turned_away = stored.where(bad).select(*self.table.data_schema.names, REASONS)
        turned_away.write.parquet(f"{self.root}/rejects/write={write}")
        return stored.where(~bad).drop(REASONS, "_bad"), [write], staged

    @contextmanager
    def staged(self, df: DataFrame) -> Iterator[DataFrame]:
        """``df`` written once beside the table, for as long as several steps read it."""
        path = f"{self.root}/staged/{uuid.uuid4().hex}"
        df.write.parquet(path)
        try:
            yield self.spark.read.schema(df.schema).parquet(path)
        finally:
            fs, jpath = self._fs(path)
            fs.delete(jpath, True)

    def compact(self, parts: list | None = None) -> int:
        """Merge the folders of each partition (or of those of the given values) into one.

        Returns the number of partitions that had several.
        """
        old = self.commit()
        wanted = None if parts is None else {_part_of(v) for v in parts}
        many = {p: ws for p, ws in old.folders.items() if len(ws) > 1 and (wanted is None or p in wanted)}
        if many:
            new = self._write(self._load(many).select(*self.table.schema.names))
            self._next(old, old.folders | {p: [new] for p in many})
        return len(many)

    def _hashed_ids(self) -> bool:
        """Whether surrogate ids are made from the keys."""
        return self.table.is_fact and self.table.pk not in self.table.data_schema.names

    def _collide(self, ids: list) -> None:
        if ids:
            raise ValueError(f"{self.table.pk} {ids[0]} of {self.table.name} stands for two keys")

    def _check_ids(self, written: DataFrame) -> None:
        """No surrogate id may stand for two keys of the batch."""
        if self._hashed_ids():
            pk = self.table.pk
            self._collide([r[0] for r in written.groupBy(pk).count().where("count > 1").select(pk).limit(1).collect()])

    def _key_columns(self, df: DataFrame, pk: bool = False) -> DataFrame:
        return df.select(*[F.col(k).alias(f"_new_{k}") for k in ((self.table.pk,) if pk else self.table.keys)])

    def _same_key(self):
        return reduce(
            lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in self.table.keys]
        )

    def _outdated(self, touched: dict[str, list[str]], written: DataFrame) -> tuple[dict[str, list[str]], dict[str, list[str]]]:
        """Folders, per partition, that hold some keys the batch brings again, and those of which it brings all.

        Reads key columns only, once; folders without such a key stay as they are.
        Equal keys have equal ids where ids are made from keys, so rows meet by id
        there, and one that meets another key stops the load.  What is dealt is the id and
        a second hash of the key, 128 bits together.
        """
        pk, stored = self.table.pk, self._load(touched)
        if self._hashed_ids():
            second = F.xxhash64(F.lit(pk), *reversed(self.table.keys), *[F.col(k).isNull() for k in self.table.keys])
            brought = written.select(F.col(pk).alias("_new"), second.alias("_second_new"))
            met = stored.select(pk, second.alias("_second"), "write", "part").join(brought, F.col(pk) == F.col("_new"), "left")
            again, other = F.col("_new").isNotNull(), F.col("_second") != F.col("_second_new")
        else:
            keys = self._key_columns(written).withColumn("_new", F.lit(True))
            met = stored.join(keys, self._same_key(), "left")
            again, other, pk = F.col("_new").isNotNull(), F.lit(False), "_new"
        found = met.groupBy("write", "part").agg(F.count("*").alias("n"), F.count_if(again).alias("again"), F.max(F.when(other, F.col(pk))).alias("other"))
        folders = found.collect()  # at most one row per folder
        self._collide([r["other"] for r in folders if r["other"] is not None])
        some: dict[str, list[str]] = {}
        whole: dict[str, list[str]] = {}
        for r in folders:
            if r["again"]:
                (whole if r["again"] == r["n"] else some).setdefault(r["part"], []).append(r["write"])
        return some, whole

    def insert_if_absent(self, rows: DataFrame) -> int:
        """Add rows whose natural key is new, the first of each key; existing rows are
        never changed.  New surrogate ids continue after the highest one."""
        old, t = self.commit(), self.table
        stored = self.read()
        keys = list(t.keys)
        fresh = keep_first(rows.dropna(subset=keys), keys).join(stored.select(*keys), keys, "left_anti")
        if t.pk not in rows.columns:
            start = stored.agg(F.max(t.pk)).first()[0] or 0
            fresh = assign_ids(fresh, keys, t.pk, start)
        new = self._write(t.conform(fresh).select(*t.schema.names))
        folders = dict(old.folders)
        for p in self._partitions(new):
            folders[p] = folders.get(p, []) + [new]
        self._next(old, folders)
        return self._load({p: [new] for p in self._partitions(new)}).count()


def assign_ids(df: DataFrame, keys: list[str], id_name: str, start: int = 0, lanes: int = 32) -> DataFrame:
    """Unique integer ids above ``start``, the same for the same set of keys.

    Rows are numbered by key order within hash lanes, and the lanes interleave,
    so no single task sorts all rows.
    """
    lane = F.pmod(F.xxhash64(*keys), F.lit(lanes))
    w = Window.partitionBy("_lane").orderBy(*keys)
    return (
        df.withColumn("_lane", lane)
        .withColumn(id_name, (F.lit(start) + (F.row_number().over(w) - 1) * lanes + F.col("_lane") + 1).cast("int"))
        .drop("_lane")
    )


def weekly_reset_due(table: StoredTable, max_weeks: int = 4) -> bool:
    """Whether the weekly prices start afresh: that many distinct weeks are stored.

    Ask once per run, before the first weekly file, so that one run's own files
    do not wipe each other.
    """
    return table.read().agg(F.count_distinct("semana")).first()[0] >= max_weeks
