"""Tables written to the folder that all executors share, where plan and lineage end."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a folder of our own where that is unset in local mode (tests); on a cluster unset is an error."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if sc.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="rollcall-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def settle(df: DataFrame, tag: str = "step", rows_at_once: int | None = None) -> DataFrame:
    """df written to the shared folder and read back: every later pass sees the same rows, and a lost executor loses none.

    rows_at_once: for rows of megabytes, how many a writer holds and a reader loads together; a writer looks at its bytes
    after a hundred rows only, and a reader takes thousands. The files stay until they are discarded or the folder is
    cleared, as checkpoint files do.
    """
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if rows_at_once:
        writer = writer.option("parquet.block.row.count.limit", rows_at_once)
    writer.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*written: DataFrame) -> None:
    """Deletes the files of settled tables that nothing still to be computed reads."""
    for df in written:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
