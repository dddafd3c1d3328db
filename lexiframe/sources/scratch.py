"""Intermediate tables in the folder that every executor can reach."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_folders: dict[str, str] = {}


def session_folder(spark: SparkSession) -> str:
    """The folder of this session below ``spark.checkpoint.dir``, removed when the session ends.

    Results are read lazily, so it can't go earlier. Only a local session may leave the
    setting empty; it then gets a temporary folder.
    """
    session = spark.sparkContext.applicationId
    if session not in _folders:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
            base = tempfile.mkdtemp(prefix="lexiframe-")
        folder = f"{base.rstrip('/')}/lexiframe-{session}"
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(path)
        system.deleteOnExit(path)
        _folders[session] = folder
    return _folders[session]


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of the session."""
    return f"{session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and return a reader on it.

    Cuts lineage in a way that outlives lost executors, and gives the optimizer
    the real size of the table.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
