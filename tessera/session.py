"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins and splits skewed shuffle
# partitions at run time; the session time zone is pinned so that dates and
# timestamps agree with the SQL oracle.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.parquet.filterPushdown": "true",
    # Checkpoints (BFS rounds, range slices) are removed from the shared
    # folder once the DataFrames that wrote them are unreachable.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Broadcasts are explicit (fixed-size lookup tables); keep the automatic
    # threshold at its default so Catalyst only broadcasts small scans.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def get_spark(master: str | None = None, app: str = "tessera",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Return (or create) the session with the library defaults applied."""
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
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; that setting is read from
    the session and never overridden. Only when it is unset on a local master
    (tests) a scratch folder is created and registered; executors of a
    cluster could not read such a folder, so there it is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {sc.master} share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark)
    path = f"{base}/tessera/{name}-{uuid.uuid4().hex[:12]}"
    if not _written:
        atexit.register(remove_written, spark)
    _written.append(path)
    return path


_written: list[str] = []


def remove_written(spark: SparkSession) -> None:
    """Delete the folders handed out by ``scratch_path`` so far.

    Runs by itself when the driver ends; call it earlier when no DataFrame
    that still has to be read comes from those folders.
    """
    jvm, jsc = spark.sparkContext._jvm, spark.sparkContext._jsc
    if jvm is None or jsc is None:
        return
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)


#: Session setting: shuffle files go when the query that wrote them has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, give_back: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and reread it.

    Cuts the lineage: a lost executor costs the tasks that were running, never
    the steps before, and every later reader scans the table instead of
    computing it again. ``give_back``: the shuffle files of this job go with it,
    and not when the driver happens to collect its garbage.
    """
    path = scratch_path(df.sparkSession, name)
    conf = df.sparkSession.conf
    had = conf.get(CLEANUP, None)
    try:
        if give_back:
            conf.set(CLEANUP, "true")
        df.write.parquet(path)
    finally:
        if give_back:
            conf.unset(CLEANUP) if had is None else conf.set(CLEANUP, had)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the ``stored`` tables that ``df`` reads; nothing may read them later."""
    spark = df.sparkSession
    names = {f.rsplit("/", 2)[-2] for f in df.inputFiles()}
    for path in [p for p in _written if p.rsplit("/", 1)[-1] in names]:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        _written.remove(path)


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


__all__ = ["get_spark", "checkpoint_dir", "scratch_path", "stored", "dropped", "remove_written",
           "default_parallelism",
           "DEFAULT_CONF"]
