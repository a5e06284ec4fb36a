"""File and function sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_text(df: DataFrame, path: str, single_file: bool = False, overwrite: bool = True) -> None:
    """Text sink; each row rendered as ``(f1,f2,...)``.  ``single_file``
    mirrors a parallelism-1 sink (use only for small results)."""
    line = F.concat(F.lit("("), F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns]), F.lit(")"))
    out = df.select(line.alias("value"))
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite" if overwrite else "errorifexists").text(path)


def write_delimited(df: DataFrame, path: str, field_sep: str = ",", line_sep: str = "\n",
                    overwrite: bool = True) -> None:
    """Delimited sink with row and field delimiters."""
    df.write.mode("overwrite" if overwrite else "errorifexists") \
      .option("sep", field_sep).option("lineSep", line_sep).csv(path)


def foreach_batch(df: DataFrame, fn, checkpoint: str, mode: str = "append"):
    """User sink function called per micro-batch (batch DataFrame, id)."""
    return df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint) \
        .foreachBatch(fn).start()


def append_table_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "csv",
                        trigger_available_now: bool = True):
    """Append-only stream into a file table (windowed aggregates need
    a watermark: rows are written once their window is final)."""
    w = df.writeStream.format(fmt).outputMode("append").option("path", path) \
          .option("checkpointLocation", checkpoint)
    if trigger_available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def write_two(df: DataFrame, is_main, main_path: str, side_path: str, fmt: str = "parquet") -> None:
    """One pass, two outputs (main + rejected).  The input is persisted
    so it is computed once, written twice."""
    cached = df.persist()
    try:
        cached.filter(is_main).write.mode("overwrite").format(fmt).save(main_path)
        cached.filter(~is_main).write.mode("overwrite").format(fmt).save(side_path)
    finally:
        cached.unpersist()


def write_two_stream(df: DataFrame, is_main, main_path: str, side_path: str, checkpoint: str,
                     fmt: str = "parquet"):
    """K16 on a stream: both outputs from each micro-batch."""
    def both(b, _id):
        write_two_append(b, is_main, main_path, side_path, fmt)
    return df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(both).start()


def write_two_append(df: DataFrame, is_main, main_path: str, side_path: str, fmt: str = "parquet") -> None:
    cached = df.persist()
    try:
        cached.filter(is_main).write.mode("append").format(fmt).save(main_path)
        cached.filter(~is_main).write.mode("append").format(fmt).save(side_path)
    finally:
        cached.unpersist()
