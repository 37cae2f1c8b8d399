"""Session helpers: a tuned local session for tests and benches, and code shipping to executors."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from py4j.clientserver import DEFAULT_WORKER_SLEEP_TIME
from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_OWN_SHARED: dict[str, str] = {}
_SCOPES: list[list[tuple[str, str]]] = []


def local_session(cpus: int = 8, app: str = "tidemark") -> SparkSession:
    """A local session with the settings that the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Make this package importable on every executor, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, f"{root.name}/{path.relative_to(root)}")
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where that is unset a temporary folder stands in for it, but only if driver and executors are one process; on a
    cluster it is an error, since executors don't see each other's folders.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_SHARED:
        _OWN_SHARED[app] = "file://" + tempfile.mkdtemp(prefix="tidemark-shared-")
    return _OWN_SHARED[app]


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table in the shared folder."""
    path = f"{shared_root(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    for made in _SCOPES:
        made.append((name, path))
    return path


@contextmanager
def scratch(spark: SparkSession, keep: str):
    """Deletes the tables that were staged inside the block when it ends, but for those whose name begins with `keep`.

    What the block leaves behind must have been written to such a table.
    """
    made: list[tuple[str, str]] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.remove(made)
        for name, path in made:
            if not name.startswith(keep):
                delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder of any store that Spark reaches; nothing happens if it is not there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def staged(df, name: str, rows: int | None = None, rows_a_file: int = 250_000, codec: str = "snappy"):
    """Write df as a table in the shared folder and read it back: cuts the lineage and survives executors.

    rows: about how many rows df has, where that is known; its last stage then runs in so few tasks that a file gets
    rows_a_file of them. A small table written by every shuffle partition would be as many files, each with its commit.
    codec: zstd where texts are staged, which it holds in two thirds of the bytes.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // rows_a_file)))
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Deletes the staged table that df was read from; nothing may read it any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete(df.sparkSession, folder)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished jobs.

    Executors keep a shuffle's files until the driver's collector finds that no plan refers to it, which a driver with
    much free memory may not look for in hours. An operator of many jobs, each of which ends in a staged table, calls
    this between them, so that its disk is that of its largest steps and not of all together. The last query's plan is
    still held when the call comes: by Python objects that refer to each other, by py4j, which tells the driver's JVM in
    rounds of a second what Python has let go of, and by the driver's threads until another query runs.
    """
    gc.collect()
    time.sleep(1.25 * DEFAULT_WORKER_SLEEP_TIME)
    spark.range(1).count()
    spark.sparkContext._jvm.System.gc()


def clean_staging(spark: SparkSession) -> None:
    """Delete every staged table of this session's shared folder. Results that still read one must be written first."""
    delete(spark, f"{shared_root(spark)}/tidemark")
