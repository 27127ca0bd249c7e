"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "lexiflow", conf: dict[str, str] | None = None) -> SparkSession:
    """Session with AQE on and the UI off.

    On a cluster, call with no arguments: master, partitions and the checkpoint
    folder come from the submitting environment.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only when it is unset on a local master
    (tests) is a fresh scratch folder created and registered; on a cluster a
    machine-local folder would be invisible to the other machines, so an unset
    folder is an error there.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    sc = spark.sparkContext
    if not path:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder all machines share (master {sc.master})")
        path = tempfile.mkdtemp(prefix="lexiflow-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    if sc.getCheckpointDir() is None or path not in _registered.get(sc.applicationId, ()):
        sc.setCheckpointDir(path)
        _registered.setdefault(sc.applicationId, set()).add(path)
    return path


_registered: dict[str, set[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared checkpoint folder for written tables.

    The application id and a random part keep two drivers that share the
    folder (and may share a process id, as in containers) apart.
    """
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    made = _scope.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete at the end every scratch location handed out inside: for work that
    has stored its result elsewhere by then, such as one micro-batch."""
    made: list[str] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in made:
            remove_path(spark, path)


_scope: ContextVar[list[str] | None] = ContextVar("lexiflow_scratch", default=None)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a written table or folder through Hadoop's file system API."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_table(df, name: str):
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: a step boundary that cuts lineage, so a result used by several
    branches of a later plan is computed once, and a lost executor re-reads
    files instead of recomputing the steps before. The shuffle files of the step go when
    it is written, not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_SHUFFLES)
        else:
            spark.conf.set(CLEAN_SHUFFLES, before)
    return spark.read.parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df):
    """Spread a scan that arrived in fewer splits than the session has cores.

    A file with one large row group is read by one task, and every per-row
    text expression after it would run on one core. Such a scan is spread
    round-robin over the cores before the CPU-heavy work; a scan that is
    already wide (the normal case on a cluster) is returned as is, so no
    shuffle is added there.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def spread_keys(df, key: str):
    """Spread a small key table over ``spark.sql.shuffle.partitions`` tasks
    before each row expands into many (delete-variants, candidate lists).

    A distinct key list is small in bytes, so AQE would coalesce it into one
    or two partitions, and the expansion would run on one core. A
    repartition on the key itself would be dropped as redundant after the
    distinct's own exchange (which AQE coalesces); hashing the key gives a
    partitioning no child satisfies, so the fixed count stands.
    """
    return df.repartition(shuffle_partitions(df.sparkSession), F.xxhash64(key))


# A side is broadcast only when both bounds hold (checked on the data).
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 128 * 1024 * 1024
_ROW_OVERHEAD = 48  # hashed-relation bytes per row beyond the values


def value_bytes(c, kind: T.DataType):
    """Bytes that a value takes, nested values included."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(c)
    elif isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
            size = F.aggregate(c, F.lit(0).cast("long"), lambda n, x: n + 8 + F.coalesce(value_bytes(x, kind.elementType), F.lit(0)))
        else:
            size = F.size(c) * 16 if isinstance(kind.elementType, T.DecimalType) else F.size(c) * 8
    elif isinstance(kind, T.MapType):
        size = (value_bytes(F.map_keys(c), T.ArrayType(kind.keyType)) + value_bytes(F.map_values(c), T.ArrayType(kind.valueType)))
    elif isinstance(kind, T.StructType):
        size = sum((value_bytes(c[f.name], f.dataType) for f in kind.fields), F.lit(8))
    else:
        size = F.lit(16)
    return F.when(c.isNotNull(), size.cast("long")).otherwise(0)


def broadcast_if_small(df, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES):
    """``broadcast(df)`` when its row count and bytes are within the bounds, else ``df``
    as is (a shuffled join; AQE handles skew there).

    One aggregate pass measures rows and the bytes of every column, nested ones included;
    pass a written (or otherwise cheap) ``df``, as the pass reads it once more.
    """
    large = [f for f in df.schema.fields
             if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))]
    size = sum((F.coalesce(F.sum(value_bytes(F.col(f"`{f.name}`"), f.dataType)), F.lit(0)) for f in large), F.lit(0))
    n, payload = df.agg(F.count(F.lit(1)), size.cast("long")).first()
    width = _ROW_OVERHEAD + 16 * (len(df.columns) - len(large))
    if n <= max_rows and payload + width * n <= max_bytes:
        return F.broadcast(df)
    return df
