"""CSV, JSON and Parquet tables."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession

from flowlens import schemas
from flowlens.operators.blocks import upsert


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A CSV table with a header. Without a schema types are inferred, which reads it twice;
    pin the inferred schema with ``schema=df.schema`` for later reads. A missing path is an error."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def stamped(name: str, at: dt.datetime | None = None) -> str:
    """``name`` with a time stamp, for outputs of repeated runs."""
    return f"{name}_{(at or dt.datetime.now()).strftime('%Y%m%d_%H%M%S')}"


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header below ``path``, which must not exist yet."""
    df.write.mode("errorifexists").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines below ``path``; times as ISO text with microseconds."""
    df.write.mode("errorifexists").option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)


def append_history(detections: DataFrame, path: str) -> None:
    """Detections added to the Parquet history."""
    detections.write.mode("append").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DETECTIONS).parquet(path)


def save_history(detections: DataFrame, path: str) -> None:
    write_json(detections, path)


def load_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DETECTIONS).json(path)


def save_blocks(ledger: DataFrame, path: str) -> None:
    write_json(ledger, path)


def load_blocks(spark: SparkSession, path: str, ledger: DataFrame | None = None) -> DataFrame:
    """The saved ledger, put over ``ledger`` where one is given."""
    loaded = spark.read.schema(schemas.BLOCKS).json(path)
    return loaded if ledger is None else upsert(ledger, loaded)


def save_evaluation(results: DataFrame, path: str) -> None:
    write_json(results, path)


def load_evaluation(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.EVALUATION).json(path)


def save_prepared(tables: dict[str, DataFrame], features: list[str], path: str) -> None:
    """Parquet tables by name and the list of feature columns below ``path``."""
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{path}/{name}")
        spark = df.sparkSession
    spark.createDataFrame([(json.dumps(features),)], "value string").coalesce(1).write.text(
        f"{path}/feature_columns")


def load_prepared(spark: SparkSession, path: str, names: list[str]) -> tuple[dict[str, DataFrame], list[str]]:
    features = json.loads(spark.read.text(f"{path}/feature_columns").first()["value"])
    return {n: spark.read.parquet(f"{path}/{n}") for n in names}, features
