"""Session factory and the helpers that need the session's settings."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from py4j.protocol import Py4JError
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

#: Settings the engine relies on; sizes are left to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "docmill", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the engine's settings; ``extra`` overrides them (dots as ``__``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (DEFAULTS | {k.replace("__", "."): v for k, v in extra.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where that is unset (tests, a laptop) a temporary folder is made; on a cluster that
    would be machine-local, so it is refused there.
    """
    global _local_dir
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="docmill-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return _local_dir


_shipped_to: dict[str, object] = {}


def ship(spark: SparkSession) -> None:
    """Sends the package to the Python workers, once for a context, so they need no copy of the repository."""
    context = spark.sparkContext
    if _shipped_to.get("context") is context:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="docmill-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/docmill.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, Path("docmill") / f.relative_to(package))
    context.addPyFile(path)
    _shipped_to["context"] = context


_folders: list[str] = []  # of this process, all removed at exit


def new_folder(spark: SparkSession, label: str) -> str:
    """A name, not yet used, for a table in the shared folder; what is there at exit is deleted."""
    path = f"{shared_dir(spark)}/docmill/{label}-{uuid.uuid4().hex}"
    _folders.append(path)
    return path


def written(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage, survives lost executors. The table is
    deleted at exit, or by :class:`Scratch` before."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(path: str) -> None:
    jvm = SparkContext._jvm
    if jvm is None:
        return
    at = jvm.org.apache.hadoop.fs.Path(path)
    context = SparkContext._active_spark_context
    conf = context._jsc.hadoopConfiguration() if context else jvm.org.apache.hadoop.conf.Configuration()
    at.getFileSystem(conf).delete(at, True)


@atexit.register
def _delete_all() -> None:
    try:
        while _folders:
            _delete(_folders.pop())
    except (Py4JError, OSError):  # the JVM has gone before; a local folder is removed as a whole
        pass


class Scratch:
    """Written tables of one job. ``clear`` deletes them once what was made from them is written itself; what is left
    (results are read when the caller acts on them) goes at exit."""

    def __init__(self) -> None:
        self._mine: list[str] = []

    def written(self, df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
        before = len(_folders)
        out = written(df, label, partition_by)
        self._mine += _folders[before:]
        return out

    def clear(self) -> None:
        for path in self._mine:
            _delete(path)
            if path in _folders:
                _folders.remove(path)
        self._mine = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are cores: a small single-file input is dealt out before costly
    Python work; an input whose scan already splits is left as it is."""
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)
