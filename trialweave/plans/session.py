"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "trialweave",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    memory: str | None = None,
    scratch: str | None = None,
) -> SparkSession:
    """A session with the settings the library relies on. ``scratch``: the shared folder, if not configured elsewhere."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if memory:
        b = b.config("spark.driver.memory", memory)
    if scratch:
        b = b.config("spark.checkpoint.dir", scratch)
    return (
        b.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else the one given to ``setCheckpointDir``.

    The library makes none by itself, as a folder of the driver's machine is not seen by executors.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        given = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = given.get() if given.isDefined() else None
    if not path:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster (or call setCheckpointDir)")
    return path.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Spark's setting for giving back the shuffle files of a finished query at once, not when the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: the lineage is cut, and
    what was computed survives the loss of any executor. The shuffle files behind it are given back, as nothing reads them again."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Removes stored tables (see ``materialize``) that nothing will read again, once what was made of them is stored itself."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Gives an input of few splits several times as many tasks as there are cores, for work that is long for its bytes.

    A split without the start of a row group is empty, so a file of one row group is one task's work however many splits it has. An input of many
    splits is returned as it is.
    """
    tasks = TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)


#: Tasks that ``spread`` makes for each core.
TASKS_PER_CORE = 4
