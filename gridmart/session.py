"""Session settings the library relies on, and the shared scratch root."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every plan in the package assumes. Applied at runtime so that a
# session owned by someone else (a driver, a notebook) still gets them.
REQUIRED_CONF = {
    # All stored instants are UTC; date_trunc/hour/to_date follow this zone.
    "spark.sql.session.timeZone": "UTC",
    # Incremental refresh rewrites only the ts_month partitions it touched.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Settings we want but do not force on a foreign session.
PREFERRED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

WAREHOUSE_CONF = "spark.gridmart.warehouse.dir"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    for key, value in PREFERRED_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def local_session(
    app: str = "gridmart", cores: str = "*", shuffle_partitions: int = 8
) -> SparkSession:
    """Session for tests and the bench: local mode, no UI, UTC."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**REQUIRED_CONF, **PREFERRED_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def app_key(spark: SparkSession) -> str:
    """Identity of the running application (also under Spark Connect)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, for written tables and checkpoints.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (or an
    explicit ``spark.gridmart.warehouse.dir``). Only when neither is set, as in
    local tests, do we make our own and register it as the checkpoint dir.
    """
    root = spark.conf.get(WAREHOUSE_CONF, None)
    if root:
        return root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
            root = None
    if not root:
        # Only for local runs with nothing configured (tests): make our own. On a
        # cluster a machine-local folder would be invisible to other executors.
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="gridmart-")
        try:
            spark.sparkContext.setCheckpointDir(os.path.join(root, "checkpoints"))
        except Exception:  # noqa: BLE001
            pass
        spark.conf.set(WAREHOUSE_CONF, root)
    return root


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process on one machine."""
    master = spark.conf.get("spark.master", "") or ""
    return master.startswith("local") and not master.startswith("local-cluster")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never-used location under the shared root (one per run)."""
    base = shared_root(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def _file(spark: SparkSession, path: str):
    """Hadoop file system and path of a location, in whatever store it lies."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder or file we wrote."""
    files, target = _file(spark, path)
    files.delete(target, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    files, target = _file(spark, path)
    return [s.getPath().getName() for s in files.listStatus(target)] if files.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file whole."""
    files, target = _file(spark, path)
    stream = files.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that appears whole or not at all; one that is there already stays."""
    folder, name = path.rsplit("/", 1)
    files, target = _file(spark, path)
    _, half = _file(spark, f"{folder}/.{name}.{uuid.uuid4().hex[:8]}")
    stream = files.create(half, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    if files.exists(target) or not files.rename(half, target):
        files.delete(half, False)
        raise FileExistsError(path)


class Scratch:
    """Intermediate tables of one job, deleted when the job ends.

    A staged table cuts the lineage at stored files: plans that join rows with
    their own per-batch aggregates otherwise repeat the whole upstream subtree
    in every branch, and a lost executor would recompute it. It survives
    executor loss (unlike a local checkpoint).
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *exc: object) -> None:
        for path in self.paths:
            delete_path(self.spark, path)

    def path(self, name: str) -> str:
        """A new location that goes when the job ends."""
        self.paths.append(fresh_path(self.spark, f"stage-{name}"))
        return self.paths[-1]

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as parquet under the shared root and read it back."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
