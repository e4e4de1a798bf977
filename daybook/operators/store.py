"""Stored tables in versions: a write is seen whole or not at all, and a write that is done again changes nothing.

A table is a folder. `data/<id>/` holds what one write wrote. `versions/<number>` names the files that make
up the table, with digests of its months and the batches it has taken. A version's file is put last, in one
step and only if nobody put that number before: readers go by the last whole one, so they never see half
of a write, and of two writers that began from the same version the second is told so.

An upsert rewrites only the files that hold one of its keys, and says what the others are by their names.
What is written is checked by the table's constraints in the same pass: a row that breaks one ends the
write, and the version before stays.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .quality import UNIQUE, guarded, orphans
from .upsert import applied_in_order, keyed_upsert

#: Bytes under which a file counts as small, and what merged files should have.
SMALL_BYTES, MERGED_BYTES = 16 << 20, 128 << 20


class Conflict(RuntimeError):
    """Another writer has put the next version first."""


@dataclass(frozen=True)
class Version:
    """What makes up a table: its files (below the folder), [n, lo, hi, digest] by month, and batches taken."""

    number: int = 0
    files: tuple[str, ...] = ()
    digests: Mapping[str, list] = field(default_factory=dict)
    batches: tuple[str, ...] = ()


class Table:
    """A table in a folder that all executors share.

    name: the constraints it keeps (quality.CONSTRAINTS, UNIQUE); month_of: the date column whose months have
    digests; refers: by column the table whose column of that name must have every value written here.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: StructType | str, name: str | None = None, month_of: str | None = None, refers: Mapping[str, Table] | None = None):
        self.refers = dict(refers or {})
        self.spark, self.folder, self.name, self.month_of = spark, folder.rstrip("/"), name, month_of
        self.schema = spark.createDataFrame([], schema).schema

    # --- files

    def _path(self, at: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{at}" if at else self.folder)

    @property
    def _fs(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _listed(self, at: str) -> list:
        path = self._path(at)
        return list(self._fs.listStatus(path)) if self._fs.exists(path) else []

    def _numbers(self) -> list[int]:
        return sorted(int(s.getPath().getName()) for s in self._listed("versions") if s.getPath().getName().isdigit() and s.getLen())

    # --- reading

    def version(self, number: int | None = None) -> Version:
        """The last version, or an earlier one that is still kept; version 0 is the table without rows."""
        known = self._numbers()
        at = (known[-1] if known else 0) if number is None else number
        if not at:
            return Version()
        stream = self._fs.open(self._path(f"versions/{at:012d}"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        said = json.loads(text)
        return Version(at, tuple(said["files"]), said["digests"], tuple(said["batches"]))

    def read(self, version: Version | None = None) -> DataFrame:
        of = self.version() if version is None else version
        return self._of(of.files)

    def _of(self, files: Sequence[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.folder}/{f}" for f in files))

    # --- writing

    def _written(self, df: DataFrame) -> list[str]:
        """Writes df, with its rows checked in the same pass; gives the files."""
        at = f"data/{uuid.uuid4().hex}"
        df = df.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields))
        guarded(df, self.name).write.parquet(f"{self.folder}/{at}")
        files = [f"{at}/{s.getPath().getName()}" for s in self._listed(at) if s.getPath().getName().endswith(".parquet")]
        for column, parent in self.refers.items():
            lost = orphans(self._of(files).select(column).distinct(), parent.read(), column)
            if files and not lost.isEmpty():
                raise ValueError(f"constraints broken: {column} {lost.first()[0]} is not in {parent.folder}")
        return files

    def bytes(self) -> int:
        """The size of the last version's files, by their listing."""
        return sum(self._fs.getFileStatus(self._path(f)).getLen() for f in self.version().files)

    def _put(self, base: Version, files: Sequence[str], digests: Mapping[str, list], batches: Sequence[str]) -> Version:
        number = base.number + 1
        text = json.dumps({"files": list(files), "digests": dict(digests), "batches": list(batches)})
        draft = self._path(f"versions/draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        target = self._path(f"versions/{number:012d}")
        context = self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, target, none)  # fails if the number is taken
        except Exception as error:
            self._fs.delete(draft, False)
            if self._fs.exists(target):
                raise Conflict(f"version {number} of {self.folder} was put by another writer") from error
            raise
        return Version(number, tuple(files), digests, tuple(batches))

    def _unique(self, files: Sequence[str], what: str) -> None:
        keys = UNIQUE.get(self.name or "", ())
        if keys and files:
            again = self._of(files).dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
            if not again.isEmpty():
                raise ValueError(f"constraints broken: {what} repeats keys {keys}")

    def replace(self, df: DataFrame) -> Version:
        """The table is df from now on."""
        base = self.version()
        files = self._written(df)
        self._unique(files, "the table")
        return self._put(base, files, self._digests(files), base.batches)

    def append(self, df: DataFrame, batch: str) -> Version:
        """df's rows come to the table, unless it has taken this batch already: a batch that is replayed changes nothing."""
        base = self.version()
        if batch in base.batches:
            return base
        files = self._written(df)
        self._unique([*base.files, *files], f"batch {batch}")
        return self._put(base, [*base.files, *files], self._summed(base.digests, self._digests(files), {}), [*base.batches, batch])

    def upsert(self, updates: DataFrame, keys: Sequence[str], rules: Mapping[str, str], order: Sequence[str] = (), batch: str | None = None) -> Version:
        """Keyed upsert (see operators.upsert). Only files that hold a key of updates are rewritten.

        updates may hold a key several times if `order` says in which order its rows take effect.
        """
        base = self.version()
        if batch is not None and batch in base.batches:
            return base
        rules = {c: r for c, r in rules.items() if c in updates.columns}
        if order:
            updates = applied_in_order(updates, keys, rules, *order)
        touched = self.touched(updates, keys, base)
        new = keyed_upsert(self._of(touched), updates, keys, rules)
        files = self._written(new)
        self._unique(files, "the update")
        kept = set(touched)
        digests = self._summed(base.digests, self._digests(files), self._digests(touched))
        return self._put(base, [*(f for f in base.files if f not in kept), *files], digests, [*base.batches, *([batch] if batch is not None else [])])

    def touched(self, updates: DataFrame, keys: Sequence[str], version: Version | None = None) -> list[str]:
        """The files that hold a key of updates. The keys' least and greatest values leave most files unread by their statistics."""
        of = self.version() if version is None else version
        if not of.files:
            return []
        firm = [k for k in keys if not dict(updates.dtypes)[k].startswith(("array", "struct", "map"))]
        ends = updates.agg(*(F.min(k).alias(f"a{i}") for i, k in enumerate(firm)), *(F.max(k).alias(f"b{i}") for i, k in enumerate(firm)), *(F.count_if(F.col(k).isNull()).alias(f"n{i}") for i, k in enumerate(firm))).first()
        held = self._of(of.files)
        for i, k in enumerate(firm):
            if ends[f"a{i}"] is not None and not ends[f"n{i}"]:
                held = held.filter(F.col(k).between(F.lit(ends[f"a{i}"]), F.lit(ends[f"b{i}"])))
        same = F.lit(True)
        for k in keys:
            same = same & F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))
        found = held.select(*keys, F.col("_metadata.file_path").alias("_file")).alias("o").join(updates.select(*keys).alias("n"), same, "left_semi").select("_file").distinct()
        names = {f.rsplit("/", 2)[-2] + "/" + f.rsplit("/", 1)[-1]: f for f in of.files}
        return sorted(names["/".join(r["_file"].rsplit("/", 2)[-2:])] for r in found.collect())  # a row a file

    def merge(self, small: int = SMALL_BYTES, merged: int = MERGED_BYTES) -> Version:
        """The same rows in fewer files: small files become files of about `merged` bytes."""
        base = self.version()
        sizes = {f: self._fs.getFileStatus(self._path(f)).getLen() for f in base.files}
        few = [f for f, n in sizes.items() if n < small]
        if len(few) < 2:
            return base
        files = self._written(self._of(few).coalesce(max(1, sum(sizes[f] for f in few) // merged)))
        gone = set(few)
        return self._put(base, [*(f for f in base.files if f not in gone), *files], base.digests, base.batches)

    def forget(self, keep: int = 2) -> None:
        """Deletes all but the last versions, and the files that none of them names."""
        known = self._numbers()
        old, kept = known[:-keep], known[-keep:]
        used = {f for n in kept for f in self.version(n).files}
        before = {f for n in old for f in self.version(n).files}
        for n in old:
            self._fs.delete(self._path(f"versions/{n:012d}"), False)
        for f in before - used:
            self._fs.delete(self._path(f), False)

    # --- digests

    def _month(self) -> Column:
        return F.coalesce(F.date_format(self.month_of, "yyyy-MM"), F.lit("")) if self.month_of else F.lit("")

    def _digests(self, files: Sequence[str]) -> dict[str, list]:
        """[n, lo, hi, digest] of each month of the files' rows; the digests are sums of row hashes."""
        if not files:
            return {}
        low = F.col(self.month_of).cast("string") if self.month_of else F.lit(None).cast("string")
        rows = self._of(files).groupBy(self._month().alias("m")).agg(F.count("*").alias("n"), F.min(low).alias("lo"), F.max(low).alias("hi"), F.sum(F.xxhash64(*(f"`{n}`" for n in self.schema.names)).cast("decimal(38,0)")).cast("string").alias("d"))
        return {r["m"]: [r["n"], r["lo"], r["hi"], r["d"]] for r in rows.collect()}  # a row a month

    @staticmethod
    def _summed(old: Mapping[str, list], more: Mapping[str, list], less: Mapping[str, list]) -> dict[str, list]:
        """Old digests with more rows and without others; keys never go, so that the ends only widen."""
        out = {}
        for month in {*old, *more}:
            parts = [x[month] for x in (old, more) if month in x]
            gone = less.get(month, [0, None, None, "0"])
            n = sum(p[0] for p in parts) - gone[0]
            ends = [[p[k] for p in parts if p[k] is not None] for k in (1, 2)]
            if n:
                out[month] = [n, min(ends[0], default=None), max(ends[1], default=None), str(sum(int(p[3]) for p in parts) - int(gone[3]))]
        return out

    def fingerprint(self, version: Version | None = None) -> tuple[int, str | None, str | None, int]:
        """n, lo, hi and digest of the whole table, as audit.fingerprint gives them over its columns, from what the version keeps: no row is read."""
        kept = (self.version() if version is None else version).digests.values()
        return sum(k[0] for k in kept), min((k[1] for k in kept if k[1] is not None), default=None), max((k[2] for k in kept if k[2] is not None), default=None), sum(int(k[3]) for k in kept)

    def changed_months(self, before: Version, after: Version | None = None) -> list[str]:
        """Months whose rows differ between two versions."""
        a, b = before.digests, (self.version() if after is None else after).digests
        return sorted(m for m in {*a, *b} if a.get(m) != b.get(m))


