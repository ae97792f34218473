"""Session defaults and table access shared by every query."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | None = None, app: str = "itemforge") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once for each Spark context, wherever they run and whatever their path is."""
    sc, root = spark.sparkContext, Path(__file__).resolve().parent
    if getattr(sc, "_itemforge_sent", False) or not root.is_dir():
        return
    folder = tempfile.mkdtemp(prefix="itemforge")
    target = Path(folder) / "itemforge.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path("itemforge") / p.relative_to(root))
    sc.addPyFile(str(target))  # executors fetch it from the driver
    atexit.register(shutil.rmtree, folder, True)
    sc._itemforge_sent = True


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One table of a data directory, pruned to ``columns`` when given."""
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table whose rows mean much work each: one that the scan cuts into few pieces is spread over the cores.

    Large tables have more pieces than cores and are left as the scan cuts them; no shuffle is added there.
    """
    df = table(spark, sf_dir, name, *columns)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names; where it names none, a private one of a local session.

    On a cluster a folder of one machine would lose checkpoints with it, so there the setting is required.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no shared folder")
        sc.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints")
    return sc.getCheckpointDir()
