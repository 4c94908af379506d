"""Sessions, and sending this package to executors that do not have it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Makes the package importable in Python workers, wherever they run: Spark hands out a zip of its sources, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="folioforge-")  # the driver serves the file from here while the application lives
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        to = Path(folder) / f"{root.name}.zip"
        with zipfile.ZipFile(to, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(to))
        _SHIPPED.add(app)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


_MADE: list[str] = []


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder that driver and executors share: under spark.checkpoint.dir, or, where that is unset and all run on one machine, one of our own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file:///tmp/folioforge-checkpoints"
    _MADE.append(f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}")
    return _MADE[-1]


def stored(df: DataFrame, label: str, made: list[str] | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder, read again: cuts the lineage and survives lost executors. The folder is added to ``made``."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    if made is not None:
        made.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_shared(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Removes tables written to the shared folder (all that this driver wrote, if none are named) once no result that reads them is needed."""
    n = 0
    for name in list(_MADE if paths is None else paths):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        n += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        if name in _MADE:
            _MADE.remove(name)
    return n


def local_session(cores: str | int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("folioforge")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.adaptive.enabled", "true").config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
