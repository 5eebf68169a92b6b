"""Session settings, the shared folder, and lineage cuts that survive lost executors."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def spark_session(cores: int = 8, partitions: int | None = None) -> SparkSession:
    """A local session for tests and bench; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tessera")
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as a URI without a trailing slash.

    The cluster names it in spark.checkpoint.dir. Where that is unset and the master is local, a
    folder of this machine is made once; elsewhere a machine-local folder would lose data, so it
    is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        sc = spark.sparkContext
        named = sc.getCheckpointDir()
        if not named:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            named = f"file://{tempfile.mkdtemp(prefix='tessera-')}"
            sc.setCheckpointDir(named)
            atexit.register(shutil.rmtree, urlparse(named).path, ignore_errors=True)
    return qualified(spark, named).rstrip("/")


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI: one without a scheme is on the cluster's default file system, as Spark itself
    reads it, which need not be this machine's."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = system.makeQualified(target).toString()
    return f"file://{uri.removeprefix('file:')}" if uri.startswith("file:/") and not uri.startswith("file://") else uri


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared one; removed when the session's driver ends, by the file
    system that holds it."""
    path = f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"
    local = urlparse(path)
    if local.scheme == "file":
        atexit.register(shutil.rmtree, local.path, ignore_errors=True)
    else:
        atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001 - the session has ended; nothing depends on the folder
        pass


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df below the shared folder and read it back: later work starts from files, so a lost
    executor costs no recomputation and no driver memory."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a ranked list, keys and ranks alone, that are sent to every task: about 16 MB.
FEW = 200_000


def sent_if_few(rows: DataFrame, of: DataFrame) -> DataFrame:
    """rows, sent to every task if `of`, the stored hits that they come from, has at most FEW rows: what
    they are joined with are all texts, which else are shuffled where the session's threshold for
    broadcasts is below the hits' size. More rows are left to Spark."""
    return F.broadcast(rows) if of.count() <= FEW else rows


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers of any cluster, once for each application, and
    bound the bytes of an Arrow batch where the session leaves that at Spark's 64 MB: a worker holds
    a whole batch, and ten thousand long texts may come in one."""
    sc = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "67108864b":
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    here = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in sorted(os.walk(here)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("tessera", os.path.relpath(full, here)))
    folder = tempfile.mkdtemp(prefix="tessera-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "tessera_package.zip")
    with open(path, "wb") as f:
        f.write(data.getvalue())
    sc.addPyFile(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
