"""Spark session defaults and lineage helpers.

Everything downstream is lazy DataFrame code; this module only decides how a
session is configured and where reliable checkpoints go.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library relies on. Wall-clock invoice strings carry
# no zone, so the session zone is pinned to UTC (day differences and month
# truncation then never cross a DST edge).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tillwise",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster leave ``master`` unset and let spark-submit decide; tests pass
    ``local[*]`` and a small shuffle partition count.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the session settings the operators depend on (idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def prefer_hash_joins(spark: SparkSession) -> SparkSession:
    """Shuffled joins of which AQE measured every partition of one side below
    64 MB hash that side instead of sorting both: the raw lines are not sorted
    for their joins with orders and parts. A setting of the session's own stays."""
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    if spark.conf.get(name, "0b") in ("0", "0b"):
        spark.conf.set(name, "64m")
    return spark


@contextmanager
def small_disk(spark: SparkSession):
    """Inside the block the shuffle files of a job go when it ends, not when the
    driver next collects its garbage, and Parquet is written with zstd (a codec
    that the session has chosen stays). A frame that runs twice makes its
    shuffles twice."""
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if spark.conf.get("spark.sql.parquet.compression.codec") == "snappy":    # the default
        wanted["spark.sql.parquet.compression.codec"] = "zstd"
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def ensure_checkpoint_dir(spark: SparkSession, folder: str | None = None) -> str:
    """Return the reliable checkpoint folder of the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that setting
    is used as is. Where it is unset, ``folder`` is used. Only a single-process
    session (master ``local`` or ``local[n]``) without either gets a private
    folder; a cluster (``local-cluster`` too) without it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = folder
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a shared, "
                               "durable folder (lineage cuts are written there)")
        configured = tempfile.mkdtemp(prefix="tillwise-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


# the innermost open scratch() block of this thread; other threads' queries aren't part of it
_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def new_folder(spark: SparkSession, kind: str) -> str:
    """An unused path in the checkpoint folder. ``scratch`` deletes it at the
    end of its block, ``forget_at_exit`` when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tillwise-{kind}-{uuid.uuid4().hex}"
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def forget_at_exit(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.deleteOnExit(where)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """The folders directly under ``path`` (none if it isn't there)."""
    fs, where = _file_system(spark, path)
    found = fs.listStatus(where) if fs.exists(where) else []
    return [f.getPath().toString() for f in found if f.isDirectory()]


@contextmanager
def scratch(spark: SparkSession):
    """Deletes the intermediate tables written inside the block when it ends;
    results must have been written or collected by then. Queries that run in
    other threads keep their tables."""
    mine: list[str] = []
    token = _SCOPE.set(mine)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in mine:
            delete_folder(spark, path)


def cut_lineage(df: DataFrame, path: str | None = None, mode: str = "overwrite") -> DataFrame:
    """Materialise ``df`` as parquet in the session's shared checkpoint folder
    and read it back (never a local checkpoint).

    One computation of the plan (``Dataset.checkpoint`` runs it twice unless
    cached); the result survives lost executors, every later job sees exactly
    the same rows, and the read-back frame carries file statistics AQE uses
    for join planning. The folder goes with the enclosing ``scratch`` block,
    or else when the application ends; ``path``, a ``new_folder`` of an outer
    block, goes with that one; ``mode`` ``"append"`` adds to what is there.
    """
    spark = df.sparkSession
    path = path or new_folder(spark, "cut")
    df.write.mode(mode).parquet(path)
    forget_at_exit(spark, path)
    return spark.read.parquet(path)
