"""Session for tests and the bench, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
RELEASE_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session as tests and the bench use it; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("panelwright")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: the one the cluster names.

    Only a local session without that setting gets a temporary folder.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    made = tempfile.mkdtemp(prefix="panelwright-")
    spark.conf.set(CHECKPOINT_CONF, made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; nothing is overwritten."""
    return f"{shared_dir(spark)}/panelwright/{name}-{uuid.uuid4().hex}"


@contextmanager
def released_shuffles(spark: SparkSession):
    """What runs meanwhile deletes its shuffle files as it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(RELEASE_CONF, None)
    spark.conf.set(RELEASE_CONF, "true")
    try:
        yield
    finally:
        spark.conf.unset(RELEASE_CONF) if before is None else spark.conf.set(RELEASE_CONF, before)


def cut_lineage(df, name: str, release: bool = False):
    """Write ``df`` once to the shared folder and go on from the written table.

    Used before iterative work, so that a lost executor costs a re-read and
    not a replay of everything before. ``release``: its shuffle files go once it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if release:
        with released_shuffles(spark):
            df.write.parquet(path)
    else:
        df.write.parquet(path)
    out = spark.read.parquet(path)
    out._scratch_path = path
    return out


def discard(*written) -> None:
    """Delete tables of ``cut_lineage`` from the shared folder once all that reads them has been written itself."""
    for df in written:
        path, spark = getattr(df, "_scratch_path", None), df.sparkSession
        if path and path.startswith(f"{shared_dir(spark)}/panelwright/"):
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
