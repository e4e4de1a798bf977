"""What several of the corpus operators share: scratch tables and global order statistics."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Documents whose crc32(doc_id as text) leaves this remainder are held out of every fit.
FOLDS, HELD_OUT = 5, 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. A local session that names none gets a folder of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="spark-daybook-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared


#: Where the tables that written() gave are.
_PATHS: WeakKeyDictionary = WeakKeyDictionary()


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared scratch folder and reads it back.

    This cuts the lineage, so that a lost executor costs one task of the reader and not the work
    before it, and fixes values such as partition numbers that would differ if computed twice.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def removed(df: DataFrame) -> None:
    """Deletes a table that written() gave and that nothing needs any more."""
    path = _PATHS.pop(df, None)
    if path:
        context = df.sparkSession.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def held_out(doc_id: str = "doc_id"):
    """True for the documents that no fit may learn labels from (null ids: not held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def hash_share(col: str, rows: int, most: int):
    """A filter that keeps about `most` of `rows` rows, chosen by a hash of `col`; all, if fewer."""
    grain = 1 << 20
    keep = grain if rows <= most else max(1, grain * most // rows)
    return F.pmod(F.xxhash64(F.lit("share"), F.col(col)), F.lit(grain)) < keep


def give_back() -> None:
    """Hands memory that Arrow and C's allocator keep back to the system, for what this worker process runs next."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def small_parts(batches, rows: int = 1000):
    """The batches in parts of at most `rows` rows, so that a task's Python objects stay few; unused memory goes back after each batch."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)
        del batch
        give_back()


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before those that df has already (in any case of letters)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def sliced(texts: list[str], most: int = 1 << 20):
    """Consecutive ranges of `texts` with about `most` characters each, or one text that is longer."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, k
            start, size = k, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)
