"""Session defaults and the shared folder for staged tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "newsflow", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs rely on; cluster settings given in ``conf`` win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder the cluster names, else in one of the warehouse, which executors share too."""
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage and keeps costly columns from being computed once per consumer. Being a written
    table it survives executor loss, and later readers still prune columns and push filters.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
