"""Tables in versioned folders behind one commit marker (SNK-1, SPEC-12, EXT-2).

A run writes every table into new folders and then commits one small file that lists, for
each table, the folders that are its content now, with the run's high-water marks. Readers
take the newest committed list, so they see the state before the run or after it, never a
mixture; a run that dies leaves folders that no list names, and a rerun starts from the
last commit. Files are never changed once written.

A table may be kept in parts: buckets of its key, or any small set of labels. A write of
some parts leaves the files of the others as they are; rows whose keys a bucket does not
hold yet are added to it without writing it again. One run at a time may write: a
commit that another run has overtaken is refused. The folder's file system must rename a
file in one step, as HDFS and local disks do.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.operators.dedup import latest_by_key
from tidewater.sources.sinks import observed
from tidewater.sources.tables import as_lookup

#: Label of the only part of a table that is not kept in parts.
WHOLE = "all"
PART = "part"
#: Folders that a bucket grows to before a batch rewrites it as one.
MOST_FOLDERS = 16


class TableStore:
    """Committed tables under ``root`` (any folder that Spark can write)."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    # --------------------------------------------------------------- files
    def _path(self, relative: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{relative}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, relative: str) -> list[str]:
        fs, path = self._fs(), self._path(relative)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    # --------------------------------------------------------------- commits
    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self._names("commits") if n.endswith(".json")]

    def state(self, version: int | None = None) -> dict:
        """What a commit (the newest one by default) lists: tables and marks."""
        known = self.versions()
        if version is None:
            if not known:
                return {"version": 0, "tables": {}, "marks": {}}
            version = known[-1]
        return json.loads(self.spark.read.text(f"{self.root}/commits/{version:012d}.json", wholetext=True).first()[0])

    def _commit(self, state: dict) -> None:
        fs = self._fs()
        final, draft = self._path(f"commits/{state['version']:012d}.json"), self._path(f"drafts/{uuid.uuid4().hex}")
        fs.mkdirs(final.getParent())
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        out.close()
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"version {state['version']} was committed by another run")

    # --------------------------------------------------------------- reading
    def load(self, entry: dict, parts: Sequence[str] | None = None) -> DataFrame:
        """The rows of a table's entry in a commit, of some parts if named."""
        schema = StructType.fromJson(entry["schema"])
        folders = [f for part, held in entry["parts"].items() if parts is None or part in parts for f in held]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.format(self.fmt).schema(schema).load([f"{self.root}/{f}" for f in folders])

    def read(self, table: str, version: int | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        tables = self.state(version)["tables"]
        if table not in tables:
            raise KeyError(f"no committed table {table}")
        return self.load(tables[table], parts)

    def begin(self) -> "Run":
        return Run(self)

    def remove_unlisted(self, keep: int = 1) -> list[str]:
        """Delete folders that none of the newest ``keep`` commits lists, and the older
        commits: what crashed runs and replaced versions left. Not while a run writes."""
        versions = self.versions()
        listed = {f for v in versions[-keep:] for e in self.state(v)["tables"].values() for held in e["parts"].values() for f in held}
        fs, gone = self._fs(), []
        for v in versions[:-keep]:
            fs.delete(self._path(f"commits/{v:012d}.json"), False)
        fs.delete(self._path("drafts"), True)
        for table in self._names("data"):
            for run in self._names(f"data/{table}"):
                folder = f"data/{table}/{run}"
                if folder in listed:
                    continue
                inner = [f for f in listed if f.startswith(folder + "/")]
                for name in ([""] if not inner else [f"/{n}" for n in self._names(folder) if "=" in n]):
                    if folder + name not in inner:
                        fs.delete(self._path(folder + name), True)
                        gone.append(folder + name)
        return gone


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")


class Run:
    """One run's writes on top of the newest commit; nothing shows before ``commit``.
    Tables may be written from several threads."""

    def __init__(self, store: TableStore):
        self.store, self.id = store, uuid.uuid4().hex
        self.base = store.state()
        self.tables = json.loads(json.dumps(self.base["tables"]))
        self.marks = dict(self.base["marks"])
        self._lock, self._count = threading.Lock(), 0

    def _folder(self, table: str) -> str:
        with self._lock:
            self._count += 1
            return f"data/{table}/{self.id}-{self._count}"

    def forget(self) -> None:
        """Start from nothing: the commit will list only what this run writes."""
        self.tables, self.marks = {}, {}

    def has(self, table: str) -> bool:
        return table in self.tables

    def read(self, table: str, parts: Sequence[str] | None = None) -> DataFrame:
        return self.store.load(self.tables[table], parts)

    def _save(self, df: DataFrame, folder: str, part: Column | None, observe: dict[str, Column], placed: bool = False) -> dict:
        """``placed``: rows have their part and lie in its order, so the write moves none."""
        seen = Observation("written")
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in observe.items()])
        if part is None and not placed:
            df.write.format(self.store.fmt).save(f"{self.store.root}/{folder}")
        else:
            rows = df if placed else df.withColumn(PART, part).hint("rebalance", PART)
            rows.write.format(self.store.fmt).partitionBy(PART).save(f"{self.store.root}/{folder}")
        plain = df.schema
        return observed(seen, list(observe), lambda: self.store.spark.read.format(self.store.fmt).schema(plain)
                        .load(f"{self.store.root}/{folder}"))

    def _folders(self, folder: str, in_parts: bool) -> dict[str, list[str]]:
        if not in_parts:
            return {WHOLE: [folder]}
        return {n.split("=", 1)[1]: [f"{folder}/{n}"] for n in self.store._names(folder) if n.startswith(f"{PART}=")}

    def write(self, table: str, df: DataFrame, part: Column | None = None, observe: dict[str, Column] | None = None,
              **kept) -> dict:
        """Replace a table by ``df``; what was observed on the write, ``rows`` included."""
        folder = self._folder(table)
        seen = self._save(df, folder, part, observe or {})
        with self._lock:
            self.tables[table] = {"schema": df.schema.jsonValue(), "parts": self._folders(folder, part is not None), **kept}
        return seen

    def staged(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written once beside the tables and read back, for what a run uses several
        times. No commit lists it."""
        folder = self._folder(f"{name}-batch")
        self._save(df, folder, None, {})
        return self.store.load({"schema": df.schema.jsonValue(), "parts": {WHOLE: [folder]}})

    def append(self, table: str, df: DataFrame, part: str = WHOLE, observe: dict[str, Column] | None = None) -> dict:
        """Add the rows of ``df`` to one part of a table."""
        folder = self._folder(table)
        seen = self._save(df, folder, None, observe or {})
        with self._lock:
            entry = self.tables.setdefault(table, {"schema": df.schema.jsonValue(), "parts": {}})
            if seen["rows"]:
                entry["parts"].setdefault(part, []).append(folder)
        return seen

    def replace_part(self, table: str, df: DataFrame, part: str) -> dict:
        folder = self._folder(table)
        seen = self._save(df, folder, None, {})
        with self._lock:
            entry = self.tables.setdefault(table, {"schema": df.schema.jsonValue(), "parts": {}})
            entry["parts"][part] = [folder]
        return seen

    def _new_parts(self, table: str) -> dict[str, list[str]]:
        old = {f for held in self.base["tables"].get(table, {"parts": {}})["parts"].values() for f in held}
        return {p: new for p, held in self.tables[table]["parts"].items() if (new := [f for f in held if f not in old])}

    def grew(self, table: str) -> bool:
        """Whether this run has written rows of a table."""
        return bool(self._new_parts(table))

    def added(self, table: str) -> DataFrame:
        """The rows that this run has appended to a table."""
        return self.store.load({**self.tables[table], "parts": self._new_parts(table)})

    def _save_latest(self, df: DataFrame, folder: str, keys: list[str], label: Column, order_col: str,
                     tie_breakers: Sequence[str] | None) -> dict:
        """The latest row of each key, in buckets. A bucket follows from the key, so the rows
        that meet by key are in the order of their buckets too: they move and are sorted once."""
        one = latest_by_key(df.withColumn(PART, label), [PART, *keys], order_col, tie_breakers)
        return self._save(one, folder, None, {}, placed=True)

    def upsert(self, table: str, batch: DataFrame, keys: Sequence[str], order_col: str, buckets: int = 64,
               newest: bool = False, tie_breakers: Sequence[str] | None = None) -> dict:
        """Merge ``batch`` into a table kept in buckets of its key: only buckets that the
        batch touches are read, and only those that hold one of its keys are written again;
        others get the batch's rows as a further folder. The batch wins over the table, or
        with ``newest`` the row with the greatest ``order_col``, wherever it comes from.
        Returns the rows of the touched buckets and their labels."""
        keys, folder, columns = list(keys), self._folder(table), batch.columns
        first = not self.has(table)  # nothing to merge with
        label = bucket_of(keys, buckets if first else self.tables[table]["buckets"])
        seen = self._save_latest(batch, folder, keys, label, order_col, tie_breakers)
        held = self._folders(folder, True)  # the batch's buckets are the touched ones
        if first:
            with self._lock:
                self.tables[table] = {"schema": batch.schema.jsonValue(), "parts": held, "buckets": buckets}
            return {"rows": seen["rows"], "touched": sorted(held)}
        entry = self.tables[table]
        one = {"schema": batch.schema.jsonValue(), "parts": held}
        met = self._met(self.read(table, list(held)), as_lookup(self.store.load(one), seen["rows"]), keys, label, newest)
        alike = {f.name: f.dataType for f in StructType.fromJson(entry["schema"])} == {f.name: f.dataType for f in batch.schema}
        mixed = [p for p in held if p in entry["parts"]
                 and (not alike or met.get(p, (0, 0))[1] or len(entry["parts"][p]) >= MOST_FOLDERS)]
        merged = {}
        if mixed:
            old, new = self.read(table, mixed).select(*columns), self.store.load(one, mixed)
            target = self._folder(table)
            if newest:
                self._save_latest(old.unionByName(new), target, keys, label, order_col, tie_breakers)
            else:
                self._save(old.join(new.select(*keys), keys, "left_anti").select(*columns).unionByName(new), target, label, {})
            merged = self._folders(target, True)
        with self._lock:
            for p, folders in held.items():
                entry["parts"][p] = merged[p] if p in merged else entry["parts"].get(p, []) + folders
        return {"rows": seen["rows"] + sum(n - m for n, m in met.values()), "touched": sorted(held)}

    def _met(self, old: DataFrame, new: DataFrame, keys: list[str], label: Column, null_safe: bool) -> dict[str, tuple[int, int]]:
        """For each bucket of ``old`` its rows and how many of them have their key in ``new``
        (one row a key); nothing but keys is read and moved."""
        new = new.select(*[F.col(k).alias(f"_{k}") for k in keys], F.lit(True).alias("_met"))
        same = F.lit(True)
        for k in keys:
            same = same & (F.col(k).eqNullSafe(F.col(f"_{k}")) if null_safe else F.col(k) == F.col(f"_{k}"))
        counts = old.select(*keys).join(new, same, "left").groupBy(label.alias("bucket")).agg(
            F.count(F.lit(1)).alias("rows"), F.count("_met").alias("met"))
        return {r.bucket: (r.rows, r.met) for r in counts.collect()}  # one row a touched bucket

    def commit(self) -> int:
        """Make this run's tables and marks the newest version."""
        version = self.base["version"] + 1
        self.store._commit({"version": version, "run": self.id, "tables": self.tables, "marks": self.marks})
        return version


def attempt(action: Callable[[], dict], tries: int = 2) -> tuple[dict | None, Exception | None, int]:
    """``action`` run until it succeeds, ``tries`` times at most: result, last error, attempts."""
    error = None
    for k in range(1, tries + 1):
        try:
            return action(), None, k
        except Exception as e:  # the caller records it
            error = e
    return None, error, tries
