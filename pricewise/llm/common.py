"""Shared folder, table cuts and small helpers of the llm operators."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder (reliable: survives a lost executor)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows of a small table that one file of it takes, and files that there are at least.
ROWS_OF_FILE, LEAST_FILES = 100_000, 8


def files_for(rows: int) -> int:
    """Files of a table of about so many short rows. It grows with the table, so that each
    task of the last step has a bounded part, and few rows are not spread over a file for
    each shuffle partition."""
    return max(LEAST_FILES, -(-rows // ROWS_OF_FILE))


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the session names in ``spark.checkpoint.dir``;
    ``session.remove_scratch`` deletes it when nothing reads it any more."""
    return scratch_path(spark, f"llm-{name}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts (one aggregate over one column)."""
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def power_of_two(n: float) -> int:
    """Smallest power of two that is at least ``n`` (1 at least)."""
    return 1 << max(0, math.ceil(math.log2(max(1.0, n))))
