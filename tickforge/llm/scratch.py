"""Shared scratch space: tables and files that every executor and the driver can reach.

The folder is the one the cluster names in ``spark.checkpoint.dir``.  Where that is unset
and Spark runs in local mode (tests, a laptop) a temporary folder is made once and used for the session; a cluster without it is an error.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """URI of the shared folder; also makes ``DataFrame.checkpoint`` usable."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if not _local:
            _local.append("file://" + tempfile.mkdtemp(prefix="tickforge-"))
        named = _local[0]
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh URI under the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    if sc._jsc is None:
        return
    try:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - the JVM may be gone already; scratch files only
        pass


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    name = f"_{name}"
    while name.lower() in taken:
        name += "_"
    return name


#: Parquet options for tables whose rows have megabytes: writers look at the size after each row (by default first after 100) and end a row group at 4 MB.  Statistics would keep
#: the least and greatest value of every row group, so all of a file's binary values.
LARGE_ROWS = {"parquet.block.size": 4 << 20, "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": False, "parquet.column.statistics.enabled": False}


def materialize(df: DataFrame, name: str, large_rows: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there,
    so a lost executor costs a re-read and not a recomputation.

    Writers and readers hold a row group at a time; with ``large_rows`` that is a few rows, however many a task writes.
    """
    path = new_folder(df.sparkSession, name)
    df.write.options(**(LARGE_ROWS if large_rows else {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_batches(spark: SparkSession, rows: int = 4000, size: int = 8 << 20) -> None:
    """Bound the Arrow batches sent to Python workers: documents can be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
