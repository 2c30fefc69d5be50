"""Session settings and the shared folder used for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "penmark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # collect_list per text falls back to sorting after this many groups; the
        # default of 128 would make every large task sort its exploded tokens.
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local folder would be lost with its executor.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="penmark-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier call has returned."""
    return f"{shared_root(spark)}/penmark/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder, as Parquet, and cut its lineage: the rows survive the loss of any executor."""
    spark = df.sparkSession
    path = fresh_dir(spark, "stored")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_once(df: DataFrame, path: str, by: list[str] | None = None, writers: int = 2) -> None:
    """Write ``df`` as Parquet. The shuffle files of the write, which nothing else can read, go when it ends.

    ``by`` makes a folder of each of its values; rows are not sorted for it as long as a task has at most ``writers`` of them."""
    spark, out = df.sparkSession, df.write.option("compression", "zstd")
    ours = {_CLEAN: "true"} | ({_WRITERS: str(writers)} if by else {})
    before = {k: spark.conf.get(k, None) for k in ours}
    for k, v in ours.items():
        spark.conf.set(k, v)
    try:
        (out.partitionBy(*by) if by else out).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored(df: DataFrame, name: str, schema: str | None = None) -> tuple[DataFrame, str]:
    """``df`` written once into the shared folder, and where it lies, for :func:`discard`."""
    path = fresh_dir(df.sparkSession, name)
    write_once(df, path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a stored table that no unfinished work reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
