"""Session settings and durable intermediate tables.

Iterative operators cut their lineage by writing a table to the shared folder
named in ``spark.checkpoint.dir`` and reading it back.  The table survives the
loss of any executor, its size is known to the optimizer (so broadcasts are
chosen from real sizes), and the next step starts from a plain scan.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

#: SQL settings the operators rely on; all can be changed at run time.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

_local_root: dict[str, str] = {}


def get_spark(app: str = "fundgraph", cores: str = "*", **conf: str) -> SparkSession:
    """Local session for tests and benches; a cluster passes its own session."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
    )
    for k, v in {**SETTINGS, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting falls back to a temporary
    folder; on a cluster a machine-local folder would lose data with the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    if sc.applicationId not in _local_root:
        _local_root[sc.applicationId] = tempfile.mkdtemp(prefix="fundgraph-")
    return _local_root[sc.applicationId]


def scratch_path(spark: SparkSession, name: str = "t") -> str:
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/fundgraph-{app}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def held(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` kept in one partitioning and order, for rounds that join it on ``keys`` again and again: it is shuffled once.

    A part lost with its executor is computed again; ``unpersist`` lets it go.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys).sortWithinPartitions(*keys).persist(StorageLevel.MEMORY_AND_DISK)


def bucketed(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` as a table in the shared folder, dealt into buckets by ``keys`` and sorted inside them.

    Joins on and groups by all the keys read it without an exchange, in this and in later plans,
    as long as the other side has as many buckets or is dealt into them.  The rows of one key
    make one bucket, so combine them first (one row per key and partner) where a key may be hot.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = f"fundgraph_{uuid.uuid4().hex}", scratch_path(spark, "buckets")
    writer = df.repartition(n, *keys).write.format("parquet").bucketBy(n, *keys).sortBy(*keys)
    writer.option("path", path).saveAsTable(name)
    out = spark.table(name)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete tables made by :func:`cut` that no later plan reads; other frames are left alone."""
    for t in tables:
        path = getattr(t, "__dict__", {}).get("scratch_path")
        if path is not None:
            context = t.sparkSession.sparkContext
            p = context._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(context._jsc.hadoopConfiguration()).delete(p, True)
