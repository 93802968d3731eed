"""SparkSession helpers.

On a cluster the session is created by the launcher; `configure` only sets
SQL options that the engine relies on (AQE, skew-join splitting, ANSI-safe
casts through `try_*`), and `checkpoint_dir` reads the shared folder named by
`spark.checkpoint.dir`.  A private folder is created only when that setting is
missing, which happens in local tests.
"""

from __future__ import annotations

import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's join partition even if the aggregate above needs a shuffle for it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options the operators assume (idempotent).

    Only adaptive execution and Arrow; dates come from date-only expressions, so
    the session's time zone is left alone.
    """
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "salescp", memory: str = "16g") -> SparkSession:
    """Session for tests and local benchmarks (UI off, small shuffle count)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SQL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: `spark.checkpoint.dir` if the cluster set it.

    Only when it is unset and the master is local (tests) a fresh private
    folder is made and registered; on a cluster a missing setting is an error,
    never a machine-local fallback.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors; "
                           "intermediate tables are written there")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="salescp-ckpt-"))  # the setting itself is fixed once Spark runs
    return sc.getCheckpointDir()


def cut_lineage(df, spark: SparkSession | None = None):
    """Reliable checkpoint into the shared folder (never a local checkpoint)."""
    spark = spark or df.sparkSession
    checkpoint_dir(spark)
    return df.checkpoint(eager=True)


class Scratch(list):
    """Paths that `materialize` wrote inside a `with scratch():` block."""


_OPEN: list[Scratch] = []


@contextmanager
def scratch():
    """Collect the tables written inside the block, for `drop_materialized` once nothing reads them."""
    paths = Scratch()
    _OPEN.append(paths)
    try:
        yield paths
    finally:
        _OPEN[:] = [p for p in _OPEN if p is not paths]


@contextmanager
def shuffles_go(spark: SparkSession):
    """Inside the block a query's shuffle files go as it ends, not when the driver happens to collect its garbage.

    For queries that run once: a frame that is run again makes its shuffles anew.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def note_written(*paths: str) -> None:
    """Count these paths among those of the innermost open `scratch()` block."""
    if _OPEN:
        _OPEN[-1].extend(paths)


class Rounds:
    """Tables of an iteration: what a round wrote goes as soon as the next round's tables are written.

        rounds = Rounds(spark)
        while ...:
            with rounds.next():
                current = materialize(step(current))
        rounds.done()  # the last round's tables stay, for the block around

    A round reads the tables of the one before, which are written in the shared folder and so do not need
    those of earlier rounds again, also when an executor is lost.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.last = spark, Scratch()

    @contextmanager
    def next(self):
        with scratch() as now:
            yield
        drop_materialized(self.spark, self.last)
        self.last = now

    def done(self) -> None:
        note_written(*self.last)


def materialize(df, how: str = "table", count: bool = False):
    """Compute `df` once and read it back, so several branches share one scan.

    table:      parquet in the shared checkpoint folder (columnar, cuts lineage,
                survives executor loss without recomputing the upstream scan);
    checkpoint: Spark's reliable `DataFrame.checkpoint()` into the same folder;
    persist:    executor memory/disk cache (lost blocks are recomputed);
    none:       keep the lazy plan.

    With `count=True` returns (df, rows); the row count is observed during the
    write (no extra job) and is None for `none` / `persist`.
    """
    if not count:
        return _materialize(df, how, None)[0]
    from pyspark.sql import functions as F

    out, metrics = _materialize(df, how, {"rows": F.count(F.lit(1))})
    return out, (None if metrics is None else metrics["rows"])


def materialize_counted(df, metrics: dict):
    """(the written table read back, {name: value} of aggregates observed while it was written)."""
    return _materialize(df, "table", metrics)


def _materialize(df, how: str, metrics: dict | None):
    if how == "none":
        return df, None
    spark = df.sparkSession
    if how in ("table", "checkpoint"):
        checkpoint_dir(spark)  # raises on a cluster that names no shared folder
    if how == "persist":
        from pyspark import StorageLevel

        return df.persist(StorageLevel.MEMORY_AND_DISK), None
    obs = None
    if metrics:
        from pyspark.sql import Observation

        obs = Observation("materialized")
        df = df.observe(obs, *[expr.alias(name) for name, expr in metrics.items()])
    if how == "checkpoint":
        out = cut_lineage(df, spark)
    elif how == "table":
        import uuid

        path = f"{checkpoint_dir(spark).rstrip('/')}/salescp-{uuid.uuid4().hex}"
        note_written(path)  # before the write, so that what a failed one leaves is known too
        df.write.mode("overwrite").parquet(path)
        out = spark.read.parquet(path)
    else:
        raise ValueError(f"unknown materialization {how!r}")
    return out, (dict(obs.get) if obs is not None else None)


def side_by_side(*jobs):
    """Results of functions that run Spark jobs which do not wait for each other, run at the same time."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target

    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(job)) for job in jobs]]


def drop_materialized(spark: SparkSession, paths: Scratch) -> int:
    """Delete the tables of one `scratch()` block, once nothing reads them any more.

    Goes through the Hadoop FileSystem of each path, so it works on the shared
    storage a cluster names in `spark.checkpoint.dir`.  Returns how many went.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    dropped = 0
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        if path.getFileSystem(conf).delete(path, True):
            dropped += 1
    return dropped
