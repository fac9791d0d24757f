"""Session helpers: shipping this package to the workers, and tables in the shared folder that cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_FOLDERS: dict[str, str] = {}
_WRITTEN: dict[str, list[str]] = {}


def ship(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers, once a session, wherever the driver runs from."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parent
        out = Path(tempfile.mkdtemp(prefix="voxloom-")) / f"voxloom_{uuid.uuid4().hex[:8]}.zip"
        with zipfile.ZipFile(out, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(out))
        _SHIPPED.add(app)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session or its configuration.

    Only where neither names one and Spark runs in this one process, a folder of this machine is made; on a cluster that raises, as
    executors would write where others can't read.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = sc.applicationId
    if app not in _FOLDERS:
        _FOLDERS[app] = tempfile.mkdtemp(prefix="voxloom-checkpoint-")
        atexit.register(shutil.rmtree, _FOLDERS[app], ignore_errors=True)
    return _FOLDERS[app]


def new_table(spark: SparkSession) -> str:
    """Path of a table to be written in the shared folder; :func:`drop_checkpoints` and the driver's exit delete it."""
    if not _WRITTEN:
        atexit.register(_at_exit)
    path = f"{shared_folder(spark).rstrip('/')}/voxloom-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def _at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark and spark.sparkContext._jsc:
        drop_checkpoints(spark)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written as a table to the shared folder and read back.

    Cuts lineage so that lost executors cost no recomputation, runs Python stages once however often the result is read,
    and, unlike an RDD checkpoint, computes once and lets later steps read single columns.
    """
    path = new_table(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_checkpoints(spark: SparkSession) -> int:
    """Delete the tables that :func:`checkpointed` wrote in this session, once no result needs them; return how many."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)
