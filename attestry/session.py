"""Session defaults and the one place where intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


STAGE_TABLE = "attestry_stage_"


def build_session(app: str = "attestry", cores: int | None = None, **conf: str) -> SparkSession:
    """A session for local runs; on a cluster the submitted session is used as it is."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Recording the call site of every column costs more than planning a wide rule table.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if cores is not None:
        builder = (
            builder.master(f"local[{cores}]")
            .config("spark.sql.shuffle.partitions", str(cores))
            .config("spark.driver.memory", "16g")
        )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a local master may fall back to its own folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system that Spark reaches; a missing one is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stage_root(spark: SparkSession) -> str:
    """Where this application writes its stage tables."""
    return f"{checkpoint_root(spark)}/stages-{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, instead_of: Sequence[DataFrame] = ()) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Used where several branches need the output of an expensive stage: the branches then scan a
    small columnar table (with pruning) and a lost executor only costs a re-read. ``instead_of``
    names earlier results of this function that nothing reads any more; they are deleted.
    """
    spark = df.sparkSession
    path = f"{stage_root(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for stage in instead_of:
        delete_path(spark, stage._stage_path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def materialize_buckets(df: DataFrame, keys: Sequence[str], dealt: bool = False) -> DataFrame:
    """As ``materialize``, in as many hash buckets of ``keys`` as the session's shuffles have partitions.

    Joins, groups and windows that keep to these keys read the buckets where they are. ``dealt`` says
    that ``df`` lies in these partitions already although Spark may not know it, for instance behind a
    step in Python; rows dealt otherwise give more files and the same table.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{STAGE_TABLE}{uuid.uuid4().hex}"
    path = f"{stage_root(spark)}/{name}"
    rows = df if dealt else df.repartition(buckets, *keys)
    rows.write.format("parquet").bucketBy(buckets, *keys).option("path", path).saveAsTable(name)
    out = spark.table(name)
    out._stage_path = path
    return out


def drop_stages(spark: SparkSession) -> None:
    """Delete all stage tables of this application; results that were not written yet are lost."""
    for stage in spark.catalog.listTables(pattern=f"{STAGE_TABLE}*"):
        spark.sql(f"DROP TABLE IF EXISTS {stage.name}")
    delete_path(spark, stage_root(spark))
