import datetime
import glob
import os
import shutil
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from streamlake.session import get_spark
    s = get_spark("local[4]", app="streamlake-tests", shuffle_partitions=8,
                  extra={"spark.sql.streaming.stateStore.providerClass":
                         "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sl-ckpt-"))
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="sl-test-")


def ordered_files(spark, tmp_path_factory, parts: int = 5) -> str:
    """A folder of event files by time, one micro-batch each, and a last one
    with a late row of every type (user -1) that moves the watermark past
    every window."""
    from pyspark.sql import functions as F
    top = str(tmp_path_factory.mktemp("ordered"))
    e = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    times = [r[0] for r in e.select("ts").orderBy("ts").collect()]
    last = times[-1] + datetime.timedelta(days=3)
    end = (e.limit(1).drop("event_type").withColumn("ts", F.lit(last))
           .withColumn("event_id", F.lit(-1).cast("long")).withColumn("user_id", F.lit(-1).cast("long")))
    ends = e.select("event_type").distinct().join(end, F.lit(True)).select(e.columns)
    edges = [times[k * len(times) // parts] for k in range(parts)] + [last]
    flat = f"{top}/flat"
    os.makedirs(flat)
    for k in range(parts + 1):
        part = ends if k == parts else e.filter((F.col("ts") >= F.lit(edges[k])) & (F.col("ts") < F.lit(edges[k + 1])))
        part.coalesce(1).write.parquet(f"{top}/{k}")
        shutil.copy(glob.glob(f"{top}/{k}/*.parquet")[0], f"{flat}/{k}.parquet")
        os.utime(f"{flat}/{k}.parquet", (1_000_000 + k, 1_000_000 + k))
    return flat
