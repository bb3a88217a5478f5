"""Session helpers: local sessions, reliable lineage cuts, table loading."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int = 8, app: str = "parasynth", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where none is named, a local session gets a temporary one; on a cluster
    that would be the driver's own disk, so it is an error there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    current = context._jsc.sc().getCheckpointDir()
    if not folder and not current.isEmpty():
        return current.get()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="parasynth-checkpoint-")
    if current.isEmpty():
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, batch: int | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: columns compressed, unlike a checkpoint's rows.

    ``batch``: rows that a Python function in ``df`` gets at a time, for rows of megabytes.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = conf.get(name)
    conf.set(name, str(batch or rows))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(name, rows)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small(df: DataFrame, rows: int = 200_000) -> bool:
    """True when ``df`` has at most ``rows`` rows; reads no more than that."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """Broadcast hint only behind a size check; otherwise a shuffle join."""
    return F.broadcast(df) if small(df, rows) else df


def sealed(df: DataFrame) -> DataFrame:
    """Keep later filters above the computed columns.

    Pushing a predicate down replaces each column by its definition: costly
    ones (text matching) would run again per predicate, and chains whose steps
    mention the previous one twice (random numbers) would grow without end.
    A generator node stops that at the cost of one small array per row.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.inline(F.array(row)))


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for heavy per-row work on an input of few partitions.

    Larger inputs already have more partitions than cores and stay as they are.
    Size and split come from the plan, so nothing runs to find out.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(cores) if size < cores * split else df
