"""Session set-up and the few physical decisions the operators share."""

import atexit
import os
import tempfile
import threading
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores=8, app="panelloom", memory="16g"):
    """A single-machine session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.files.minPartitionNum", str(cores))
    )
    for name, value in LOCAL_CONF.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark):
    """Folder for intermediate tables: the one the cluster names in ``spark.checkpoint.dir``.

    It may be of any scheme, ``file:`` included: shared mounts are common. Where it is unset, only
    a session whose tasks run inside the driver (``local``, ``local[n]``) gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = getattr(spark, "_panelloom_folder", None)
    if folder is None:
        folder = tempfile.mkdtemp(prefix="panelloom-")
        spark._panelloom_folder = folder
    return folder


def run_folder(spark):
    """This application's own folder inside the shared one; removed when the driver ends."""
    sc = spark.sparkContext
    folder = getattr(sc, "_panelloom_run", None)
    if folder is None:
        folder = sc._panelloom_run = f"{shared_folder(spark)}/panelloom/{sc.applicationId}-{uuid.uuid4().hex[:8]}"
        atexit.register(_release_quietly, spark)
    return folder


def scratch_path(spark):
    """A fresh path in the run's folder."""
    return f"{run_folder(spark)}/{uuid.uuid4().hex}"


def release(spark):
    """Remove what this run has staged; frames that read from it can no longer be used."""
    sc = spark.sparkContext
    folder = getattr(sc, "_panelloom_run", None)
    if folder is not None:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
        sc._panelloom_run = None


@contextmanager
def run_scope(spark):
    """A run with a folder of its own, removed at the end of the block with all it has staged."""
    sc = spark.sparkContext
    outer = getattr(sc, "_panelloom_run", None)
    sc._panelloom_run = None
    try:
        yield
    finally:
        release(spark)
        sc._panelloom_run = outer


def _release_quietly(spark):
    """At the end of the driver: a session that was stopped before has nothing to ask."""
    if spark.sparkContext._jsc is not None:
        release(spark)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Operators that read one input several times stage it first: the lineage is cut (a lost
    executor re-reads files, it does not replay the plan), later passes read only the columns
    they need, and the planner knows the true size, so it broadcasts a side only when the
    files are below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    if getattr(df, "_panelloom_staged", False):
        return df
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._panelloom_staged = True
    return out


def lookup_join(df: DataFrame, table: DataFrame, keys, how="left", ready=False) -> DataFrame:
    """Join a per-group table back to its rows; null keys never match.

    The table is staged, hence its size is known to the planner: a small one is broadcast and
    the rows are not shuffled, a large one is joined by sort-merge with adaptive skew handling.
    ``ready`` says that it already reads from a staged table.
    """
    return df.join(table if ready else stage(table), list(keys), how)


_SHIPPING = threading.Lock()


def ship_package(spark):
    """Send this package to the workers, once per session, so that tasks can import it; threads wait for one another."""
    sc = spark.sparkContext
    with _SHIPPING:
        if getattr(sc, "_panelloom_shipped", False):
            return
        root = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(prefix="panelloom-zip-"), "panelloom.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for folder, _, names in os.walk(root):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
        sc.addPyFile(path)
        sc._panelloom_shipped = True


def null_if_nan(df: DataFrame) -> DataFrame:
    """Sources turn NaN into null once; inside the engine only null means missing."""
    floats = {"double", "float"}
    return df.select([
        F.nanvl(F.col(f"`{name}`"), F.lit(None).cast(kind)).alias(name) if kind in floats
        else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ])
