"""Session settings, table loading and lineage cuts shared by all operators."""

from __future__ import annotations

import atexit
import shutil

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(app: str = "skeinmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this engine's defaults; ``conf`` (dots as ``__``) overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably and cut its lineage.

    Uses the shared folder named by ``spark.checkpoint.dir``. Where it is unset a
    local session gets one of its own beside its warehouse, removed when the process
    ends; on a cluster that is an error, as no executor could read another's.
    The result is planned with the size it has in that folder.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(folder or _own_folder(spark))
    return _measured(df.checkpoint(eager=True))


def _own_folder(spark: SparkSession) -> str:
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').removeprefix('file:')}/checkpoints-{sc.applicationId}"
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _measured(done: DataFrame) -> DataFrame:
    """A checkpointed frame with its measured size for an estimate, and no predicates carried on.

    Spark hands on the estimate of the plan that was cut, a product over all joins
    so far, as well as all predicates known of it; after a few dozen steps planning
    takes longer than the jobs. Measured, small results are broadcast and large ones never.
    """
    spark = done.sparkSession
    jvm, session = spark._jvm, spark._jsparkSession
    old = done._jdf.queryExecution().analyzed()
    file = old.rdd().getCheckpointFile()
    if file.isEmpty():
        return done
    path = jvm.org.apache.hadoop.fs.Path(file.get())
    size = path.getFileSystem(session.sparkContext().hadoopConfiguration()).getContentSummary(path).getLength()
    none = jvm.scala.Option.apply(None)
    stats = spark.range(max(size // 8, 1))._jdf.queryExecution().analyzed().stats()
    new = jvm.org.apache.spark.sql.execution.LogicalRDD(old.output(), old.rdd(), old.outputPartitioning(), old.outputOrdering(), False, none, session, jvm.scala.Option.apply(stats), none)
    return DataFrame(jvm.org.apache.spark.sql.classic.Dataset.ofRows(session, new), spark)
