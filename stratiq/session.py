"""Session and lineage helpers."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "stratiq", **conf: str) -> SparkSession:
    """A session with the settings the engine counts on; ``conf`` adds to them.

    Partition numbers are left to adaptive execution: shuffles start wide and
    are coalesced to the advisory size, skewed joins are split.
    """
    builder = SparkSession.builder.appName(app)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.  Where the session names none, a
    temporary one with a local master; elsewhere executors could not read what
    others write there, and that is an error."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not current.isDefined():
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        made = tempfile.mkdtemp(prefix="stratiq-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(f"file://{made}")
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
    return current.get().rstrip("/")


_ROOTS: set[str] = set()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder, in one of this application's
    own that is removed when the driver's JVM ends."""
    root = f"{shared_dir(spark)}/stratiq-{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _ROOTS.add(root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps start from
    the files, also after the executors that made them are gone."""
    spark = df.sparkSession
    path = scratch(spark, "settled")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join whose rows go out by key.  Spark takes the size of
    compressed files for that of the rows and what is computed from them, and
    may else send a million rows to all executors, through the driver."""
    return df.hint("merge")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, for functions
    that run in Python there."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="stratiq-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = f"{folder}/{root.name}-{uuid.uuid4().hex[:8]}.zip"
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(name)
