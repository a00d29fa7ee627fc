"""Scratch tables: lineage is cut by tables in the folder that the cluster shares.

Everything an application writes here lies below one folder, which goes when the application ends; loops give up
tables earlier, as soon as a later one has taken their place.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..config import lookup

#: A written table of known size gets a file for so many rows at least.
FILE_ROWS = 500_000
_known: dict[str, str] = {}


def _hadoop(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def scratch_dir(spark: SparkSession) -> str:
    """The folder of this application, below the one the cluster names in spark.checkpoint.dir.

    Only where the setting is absent (tests, a laptop) a temporary folder takes its place. The folder is deleted when
    the driver ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _known:
        base = lookup(spark, "spark.checkpoint.dir")
        if not base:
            found = spark.sparkContext._jsc.sc().getCheckpointDir()
            base = found.get() if found.isDefined() else None
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="graphloom-")
            spark.sparkContext.setCheckpointDir(base)
        folder = f"{base.rstrip('/')}/graphloom-{app}"
        fs, path = _hadoop(spark, folder)
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _known[app] = folder
    return _known[app]


def put(df: DataFrame, name: str, rows: int | None = None) -> str:
    """Write df to a new scratch table; its path.

    ``rows``, a bound of the number of rows where one is known, spares small tables many small files.
    """
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    (df if rows is None else df.coalesce(max(1, -(-rows // FILE_ROWS)))).write.parquet(path)
    return path


def materialize(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """df, written and read back: lineage ends here, and lost executors cost nothing."""
    return df.sparkSession.read.schema(df.schema).parquet(put(df, name, rows))


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    fs, where = _hadoop(spark, path)
    fs.delete(where, True)


def cleanup(spark: SparkSession) -> None:
    """Delete all scratch tables of the application, once no DataFrame that reads them is needed any more."""
    discard(spark, scratch_dir(spark))
