"""Scans, views and sinks (S1-S5). Thin on purpose: Spark's readers and writers do
the work, and the returned DataFrames stay lazy so Catalyst can prune columns and
push filters into the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Parquet table ``{base_dir}/{name}.parquet`` (vectorized, column-pruned scan)."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, sep: str = ",", infer_schema: bool | None = None,
             mode: str = "PERMISSIVE") -> DataFrame:
    """CSV scan. With ``schema`` no inference pass is run (one pass less over the
    files, and stable types) -- the form to use on large inputs. Without it
    ``inferSchema`` reads the whole input once more."""
    reader = (spark.read.format("csv").option("header", header).option("sep", sep)
              .option("mode", mode))
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True if infer_schema is None else infer_schema)
    return reader.load(path)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> str:
    df.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)
    return path


def write_table(df: DataFrame, name: str, path: str | None = None) -> str:
    """Parquet table in the session catalog (S4, ``saveAsTable``). With ``path``
    the files go to that shared location (an external table); without it, to the
    catalog's warehouse."""
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return name


def register_view(df: DataFrame, name: str) -> str:
    """Session-scoped temp view."""
    df.createOrReplaceTempView(name)
    return name


def sql_scan(spark: SparkSession, view: str) -> DataFrame:
    """``SELECT * FROM view`` (S3), through the SQL front end."""
    return spark.sql(f"SELECT * FROM `{view}`")
