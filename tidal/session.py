"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every tidal job relies on. AQE re-plans joins and coalesces/splits partitions from
# runtime statistics; skew-join splits a hot join key across tasks. transformWithState needs the
# RocksDB state store.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
}


def scale_conf(input_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for an input of ``input_bytes`` (pass them as ``extra`` to ``get_session``).

    Shuffle partitions start at about one per ``partition_bytes`` of input, so a partition fits
    an executor's memory with room to sort; AQE then coalesces small ones and splits skewed join
    partitions at run time. Scans read ``partition_bytes`` per task.
    """
    shuffle = max(8, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def get_session(master: str | None = None, app: str = "tidal",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or return) a session with tidal's settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the one runtime setting the stateful streams need on a session someone else built."""
    ensure_state_store(spark)


def ensure_state_store(spark: SparkSession) -> None:
    """``transformWithState`` keeps its state in RocksDB; select that provider for new queries."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) != ROCKSDB_PROVIDER:
        spark.conf.set(key, ROCKSDB_PROVIDER)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names storage every executor and the driver can reach; it is read
    from the session. Only when it is unset on a local master (local runs, tests) is a local folder
    created and installed as the checkpoint directory; on a cluster an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="tidal-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root (for stream checkpoints/outputs)."""
    root = checkpoint_root(spark)
    return os.path.join(root, "tidal", f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as parquet under the shared checkpoint root and read back."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def default_blocks(spark: SparkSession) -> int:
    """The shuffle partition count: default stream shards and salt sub-keys, and the basis of the
    pairing's hot-user threshold."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidal`` importable by Python workers (stateful processors are pickled by reference).

    Zips the package once per application and adds it with ``addPyFile``, which serves it from
    the driver to every executor, as ``--py-files`` would. The driver-side Python process that
    ``transformWithState`` starts to read the processor's state schema takes its environment
    from the function, so the zip also goes on that ``PYTHONPATH``.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="tidal-pkg-"), "tidal.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(path)
    current = sc.environment.get("PYTHONPATH", "")
    sc.environment["PYTHONPATH"] = os.pathsep.join(p for p in (path, current) if p)
    _SHIPPED.add(sc.applicationId)


@contextlib.contextmanager
def shuffle_partitions(spark: SparkSession, n: int | None):
    """Run a block (a stream start) with ``spark.sql.shuffle.partitions`` set to ``n``.

    A streaming query copies the session's settings when it starts, and a stateful query keeps
    that partition count as its number of state partitions for its whole life (it is recorded in
    the checkpoint); the session itself is restored afterwards.
    """
    if not n:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, old)
