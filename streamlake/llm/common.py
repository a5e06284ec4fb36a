"""Helpers shared by the operators: intermediate tables, whitespace, row fan-out."""

from __future__ import annotations

import atexit
import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlake.session import ensure_checkpoint_dir, ship_package

#: ASCII white space runs that separate words; a word is any run of other characters.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_WRITTEN: dict[str, SparkSession] = {}


def prepare(spark: SparkSession) -> None:
    """Shared checkpoint folder and worker code for one session. The driver
    lets go of what it holds of former stages: their plans, generated classes
    and broadcasts, which pile up over a pipeline."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    gc.collect()  # handles that keep JVM objects alive
    spark._jvm.System.gc()


def table_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder named by ``spark.checkpoint.dir``."""
    path = f"{ensure_checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(_drop_all)
    _WRITTEN[path] = spark
    return path


def write_table(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts
    the lineage, fixes the rows (they don't change when a task runs again)
    and survives lost executors.  Deleted when the application ends.
    ``files`` bounds the number of files of a table that is small by its meaning."""
    spark = df.sparkSession
    path = table_folder(spark, name)
    (df.coalesce(files) if files else df).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Python workers get ``rows`` rows at a time in the jobs run inside: whole
    texts and sets are large, and a worker holds a batch of them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def give_back() -> None:
    """The process gives the memory it no longer uses back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def trimmed(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` on a task's batches; at its end the worker, which waits for
    other tasks, gives back memory."""
    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            give_back()
    return run


def _drop_all() -> None:
    for path, spark in _WRITTEN.items():
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the session is already stopped; the folder's owner cleans up
            return


def normalise_space(text: Column) -> Column:
    """Each white space run as one space, null as empty.  Only runs that are
    not already a single space match, so most text is copied untouched."""
    return F.regexp_replace(F.coalesce(text, F.lit("")),
                            r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def word_count(text: Column) -> Column:
    """Number of words (runs of non white space), null as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def load_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One input table through Spark's reader."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
