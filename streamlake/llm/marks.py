"""Marks on rows by their position, so that no text moves to learn one.

A row is named by its file and its number in that file (``_metadata``). What a
stage finds out about rows (dropped, repeated, placed) is written as a small
table into the shared folder, split by file and by segments of rows; the task
that scans a file reads that file's marks. The plan is a scan at every size:
neither a join nor a broadcast is needed, however many rows are marked. A
task holds the marks of one segment at a time.

The shared folder has to be readable by ``pyarrow.fs`` (a mounted folder,
hdfs, s3, gs); marks are written by Spark, whose committer sees to tasks that
run twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema as _arrow_schema
from pyspark.sql.pandas.types import to_arrow_type

from .common import table_folder, write_table

SEGMENT_BITS = 20  # a segment of marks covers 2 ** 20 rows of a file
#: Between a scan and its rows' positions only these may stand: they neither repeat nor merge rows.
_KEEP_ROWS = {"Project", "Filter", "SubqueryAlias", "View", "LogicalRelation"}


def _plain_scan(df: DataFrame) -> bool:
    node = df._jdf.queryExecution().analyzed()
    while True:
        if node.nodeName() not in _KEEP_ROWS:
            return False
        if node.children().isEmpty():
            return True
        node = node.children().head()


def scan(df: DataFrame, name: str = "rows") -> DataFrame:
    """``df`` itself if it reads Parquet files row by row, else a written copy."""
    if _plain_scan(df):
        try:
            df.select(df.metadataColumn("_metadata").getField("row_index"))
            return df
        except AnalysisException:
            pass
    return write_table(df, name)


def placed(df: DataFrame) -> DataFrame:
    """``row`` (all columns as one, so names cannot clash), ``file`` (digest of
    its path) and ``at`` (row number). ``df`` comes from ``scan``."""
    meta = df.metadataColumn("_metadata")
    return df.select(F.struct("*").alias("row"), F.md5(meta.getField("file_path").cast("binary")).alias("file"),
                     meta.getField("row_index").alias("at"))


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder as Spark names it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def to_arrow_schema(fields: str) -> pa.Schema:
    return _arrow_schema(T.StructType.fromDDL(fields))


@lru_cache(maxsize=2)
def _segment(folder: str, file: str, segment: int) -> tuple[np.ndarray, pa.Table] | None:
    store, path = filesystem(folder)
    own = f"{path}/file={file}/seg={segment}"
    names = [f.path for f in store.get_file_info(fs.FileSelector(own, allow_not_found=True)) if f.path.endswith(".parquet")]
    if not names:
        return None
    parts = []
    for n in names:
        with store.open_input_file(n) as source:
            parts.append(pq.ParquetFile(source).read(use_threads=False))
    table = pa.concat_tables(parts).sort_by("at").combine_chunks()
    return table.column("at").to_numpy(), table


def lookup(folder: str, kind: pa.StructType, bits: int, file: pa.Array, at: pa.Array) -> pa.StructArray:
    """The marks of rows, null for rows without one (take a field of the
    result with ``struct_field``, which heeds that)."""
    files, rows = file.dictionary_encode(), at.to_numpy()
    keys = files.indices.to_numpy().astype(np.int64) << 40 | rows >> bits
    parts, order = [], []
    for key in np.unique(keys):
        mine = np.flatnonzero(keys == key)
        order.append(mine)
        found = _segment(folder, files.dictionary[int(key >> 40)].as_py(), int(key & (1 << 40) - 1))
        if found is None:
            parts.append(pa.nulls(len(mine), kind))
            continue
        known, table = found
        spot = np.minimum(np.searchsorted(known, rows[mine]), len(known) - 1)
        missing = known[spot] != rows[mine]
        taken = table.take(pa.array(np.where(missing, 0, spot)))
        columns = [taken.column(f.name).combine_chunks().cast(f.type) for f in kind]
        parts.append(pa.StructArray.from_arrays(columns, fields=list(kind), mask=pa.array(missing)))
    if not parts:
        return pa.nulls(0, kind)
    return pa.concat_arrays(parts).take(pa.array(np.argsort(np.concatenate(order), kind="stable")))


@dataclass(frozen=True)
class Marks:
    """A written table of marks: ``fields`` per marked row."""

    folder: str
    fields: T.StructType  # of a mark
    bits: int  # of a segment, as written: a worker's own setting may differ

    def of(self, file: Column, at: Column) -> Column:
        """The mark of a row, null without one. Only the two columns go to Python."""
        read = self.reader()

        @F.arrow_udf(self.fields)
        def mark(file: pa.Array, at: pa.Array) -> pa.Array:
            return read(file, at)

        return mark(file, at)

    def reader(self) -> Callable[[pa.Array, pa.Array], pa.StructArray]:
        """``lookup`` in this table, for functions that run in tasks anyway."""
        return partial(lookup, self.folder, to_arrow_type(self.fields), self.bits)


def save(marks: DataFrame, name: str) -> Marks:
    """Write ``marks`` (file, at, further fields); a row is marked once."""
    folder = table_folder(marks.sparkSession, name)
    rest = [f for f in marks.schema if f.name not in ("file", "at")]
    (marks.withColumn("seg", F.shiftright("at", SEGMENT_BITS)).repartition("file", "seg")
     .sortWithinPartitions("file", "seg", "at").write.option("compression", "zstd")
     .partitionBy("file", "seg").parquet(folder))
    return Marks(folder, T.StructType(rest), SEGMENT_BITS)


def without(df: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` (from ``scan``) that ``gone`` (file, at) does not name."""
    marks = save(gone.select("file", "at", F.lit(True).alias("gone")), name)
    rows = placed(df).withColumn("mark", marks.of(F.col("file"), F.col("at")))
    return rows.filter("mark is null").select("row.*")


def only(df: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """``row, file, at`` of the rows of ``df`` (from ``scan``) that ``wanted`` (file, at) names."""
    marks = save(wanted.select("file", "at", F.lit(True).alias("wanted")), name)
    rows = placed(df).withColumn("mark", marks.of(F.col("file"), F.col("at")))
    return rows.filter("mark is not null").drop("mark")
