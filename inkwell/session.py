"""Session helpers that every part of the library shares."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read through Spark so that any store it knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream of its files.

    A stream reads folders: of a table in one file, its folder with the file's
    name as the filter. (That filter tests leaf names, so it hides the part
    files of a table that is a folder itself.)
    """
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return reader.parquet(f"{sf_dir}/{name}.parquet")
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where that setting is absent and the master is this process (tests, a
    laptop) a local folder is made and set as the checkpoint folder of the
    running context; on a cluster its absence is an error.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if conf:
        return conf.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    if not is_local(spark.sparkContext.master):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder that all machines of {spark.sparkContext.master} share")
    made = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(f"file://{made}")
    return f"file://{made}"


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder as Parquet and read it back.

    This cuts the lineage: a lost executor costs the tasks it ran, not the
    stages before the write.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/inkwell/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_shared(spark: SparkSession) -> None:
    """Delete the intermediate tables of this package; DataFrames that read them end with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/inkwell")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package.

    Nothing to do where the package is on the workers' PYTHONPATH; else the
    package goes to them as a zip, once for a context, as --py-files would.
    """
    home = str(ROOT.parent)
    if home in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    sc = spark.sparkContext
    if getattr(sc, "_inkwell_shipped", False):
        return
    out = Path(tempfile.mkdtemp(prefix="spark-", dir="/tmp")) / "inkwell.zip"
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(ROOT.rglob("*.py")):
            z.write(p, p.relative_to(ROOT.parent))
    sc.addPyFile(str(out))
    sc._inkwell_shipped = True
