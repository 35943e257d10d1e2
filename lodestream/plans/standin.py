"""The test tables hold no recorded calls; ``events`` stand in for them, in the same way for Spark and for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CALLS_SQL = """(
  SELECT event_id, user_id AS submission, ts, event_type, value, props,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos,
         CASE event_type WHEN 'view' THEN 'read' WHEN 'signup' THEN 'memory_write' WHEN 'purchase' THEN 'enterprise-database' WHEN 'click' THEN 'browser' ELSE 'exec' END AS tool,
         CASE event_type WHEN 'purchase' THEN 2 WHEN 'click' THEN 3 ELSE 1 END AS tier,
         event_type <> 'view' AS is_write,
         CASE WHEN value < 10 THEN 0 WHEN value < 40 THEN 1 WHEN value < 100 THEN 2 WHEN value < 200 THEN 3 ELSE 4 END AS level
  FROM events)"""


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind, value = F.col("event_type"), F.col("value")
    tool = F.when(kind == "view", "read").when(kind == "signup", "memory_write").when(kind == "purchase", "enterprise-database").when(kind == "click", "browser").otherwise("exec")
    return events.select(
        "event_id",
        F.col("user_id").alias("submission"),
        "ts",
        "event_type",
        "value",
        "props",
        F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).cast("long").alias("pos"),
        tool.alias("tool"),
        F.when(kind == "purchase", 2).when(kind == "click", 3).otherwise(1).alias("tier"),
        (kind != "view").alias("is_write"),
        F.when(value < 10, 0).when(value < 40, 1).when(value < 100, 2).when(value < 200, 3).otherwise(4).alias("level"),
    )
