"""The test tables in the reference's shape.

The reference reads one flat table of tickets: string categoricals, boolean flags,
an ``M/D/Y`` date string, epoch seconds, a few numerics and a price label. Here
``lineitem`` is given that shape by one projection over the parquet scan (no
join, no shuffle), and the reference's preparation runs on top of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import epoch_seconds
from ..operators.features import FeatureSpec
from ..operators.prepare import PrepareSpec, prepare
from ..operators.splits import hash_split, spread, spread_partitions
from ..sources.files import read_table

# (l_orderkey, l_linenumber) repeats in these tables; with these columns a row is unique.
KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "ship_epoch")
LABEL = "price"

# Raw, reference-shaped columns derived from lineitem.
RAW_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "line_label",
               "is_discounted", "ship_date", "l_quantity", "l_extendedprice", "l_discount",
               "l_tax", "ship_epoch", "price")

PREPARE = PrepareSpec(columns=RAW_COLUMNS, flags=("is_discounted",),
                      dates={"ship_date": "ship"})

PREPARED_COLUMNS = RAW_COLUMNS + ("ship_month", "ship_day", "ship_year")

# Full feature set (the reference's shape: flag, indexed strings, date parts, scaled numerics).
FULL_SPEC = FeatureSpec(
    label=LABEL,
    flags=("is_discounted",),
    categorical=("l_returnflag", "l_linestatus", "line_label"),
    int_categorical=("ship_month", "ship_day", "ship_year"),
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax", "ship_epoch"),
)

# Without the date parts (the reference's tuned pipelines).
BASE_SPEC = FeatureSpec(
    label=LABEL,
    flags=("is_discounted",),
    categorical=("l_returnflag", "l_linestatus", "line_label"),
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax", "ship_epoch"),
)

# The same with one categorical moved to the end of the categorical vector (the boosted
# searches), and without it (the factorization machines).
BASE_LAST_SPEC = FeatureSpec(
    label=LABEL,
    flags=("is_discounted",),
    categorical=("l_linestatus", "line_label", "l_returnflag"),
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax", "ship_epoch"),
)
FEWER_SPEC = FeatureSpec(
    label=LABEL,
    flags=("is_discounted",),
    categorical=("l_linestatus", "line_label"),
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax", "ship_epoch"),
)
# Feature sets by the name that a learner preset gives.
SPECS = {"base": BASE_SPEC, "base_last": BASE_LAST_SPEC, "fewer": FEWER_SPEC, "full": FULL_SPEC}

# Two small categoricals only: a deep-enough tree predicts the training mean of
# each (returnflag, linestatus) cell, which makes the learners checkable in SQL.
CELL_SPEC = FeatureSpec(label=LABEL, categorical=("l_returnflag", "l_linestatus"))

# One continuous feature with fewer distinct values (50) than split candidates:
# every midpoint between neighbouring training values is a candidate, so the
# best single split is an exact SQL search.
STUMP_SPEC = FeatureSpec(label=LABEL, numeric=("l_quantity",))

# The same with a feature that the label depends on (11 distinct values): searches over it
# have different, exact answers for every learner.
SEARCH_SPEC = FeatureSpec(label=LABEL, numeric=("l_discount",))

# Three numerics with few distinct values: the split search of a small tree over all of
# them, and its importances, are exact SQL searches.
SMALL_SPEC = FeatureSpec(label=LABEL, numeric=("l_quantity", "l_discount", "l_tax"))


# The numerics to mean 0 and deviation 1 (linear models); one slot for each label.
STANDARD_SPEC = FeatureSpec(label=LABEL, numeric=("l_quantity", "l_discount", "l_extendedprice"),
                            scaler="standard")
ONE_HOT_SPEC = FeatureSpec(label=LABEL, one_hot=("l_returnflag", "l_linestatus", "line_label"))
GROUP_SPEC = FeatureSpec(label=LABEL, one_hot=("line_label",))

# Classification: the discount flag by the cell as one label, and a flag that depends on a
# numeric of 11 values, so that the tree's leaves predict different classes.
FLAG = "is_discounted"
FLAG_CELL_SPEC = FeatureSpec(label=FLAG, one_hot=("cell",))
MIDDLE = "is_middle"
MIDDLE_SPEC = FeatureSpec(label=MIDDLE, numeric=("l_discount",))


def raw_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference-shaped rows."""
    return shape(read_table(spark, sf_dir, "lineitem"))


def shape(li: DataFrame) -> DataFrame:
    """lineitem rows in the reference's raw shape (works on batch and stream frames)."""
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        F.col("l_linenumber").cast("string").alias("line_label"),
        (F.col("l_discount") > F.lit(0.05)).alias("is_discounted"),
        F.date_format("l_shipdate", "M/d/yyyy").alias("ship_date"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        epoch_seconds("l_shipdate").alias("ship_epoch"),
        (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))
         * (F.lit(1) + F.col("l_tax"))).alias(LABEL),
    )


def prepared_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(raw_frame(spark, sf_dir), PREPARE)


def with_classes(prepared: DataFrame) -> DataFrame:
    """Prepared rows with the (returnflag, linestatus) cell as one label, and a flag for
    discounts of 3 to 7 percent, turned round where the quantity is 10 or less."""
    middle = F.round(F.col("l_discount") * 100).between(3, 7)
    return prepared.withColumn("cell", F.concat_ws("/", "l_returnflag", "l_linestatus")) \
        .withColumn(MIDDLE, (middle != (F.col("l_quantity") <= 10)).cast("int"))


def prepared_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1000
                    ) -> DataFrame:
    """The same prepared rows as a file stream of the lineitem table: its path is one file or
    a folder of part files. A backlog is cut into micro-batches of at most
    ``max_files_per_trigger`` files, each committed to the sink's checkpoint on its own."""
    table = read_table(spark, sf_dir, "lineitem")
    stream = (spark.readStream.schema(table.schema)
              .option("maxFilesPerTrigger", max_files_per_trigger)
              # a pattern that only the table's own path matches: a plain path may not be a file
              .parquet(f"{sf_dir.rstrip('/')}/lineitem.parque[t]"))
    return prepare(shape(stream), PREPARE)


def pruned(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The row key, the spec's inputs and the label: all that a fit or a score reads."""
    extra = [c for c in (*spec.input_columns, spec.label) if c not in KEY]
    return df.select(*KEY, *dict.fromkeys(extra))


def train_and_test(spark: SparkSession, sf_dir: str, spec: FeatureSpec, ratio: float = 0.7
                   ) -> tuple[DataFrame, DataFrame]:
    """(train, test) rows by key hash, with the columns that ``spec`` needs. Training rows
    are spread by the hash of their key over partitions whose number depends on the table
    only; test rows are scored where they are."""
    rows = with_classes(prepared_frame(spark, sf_dir))
    train, test = hash_split(pruned(rows, spec), KEY, ratio)
    n = read_table(spark, sf_dir, "lineitem").count()  # from the files' footers
    return spread(train, KEY, spread_partitions(n)), test


def train_rows(spark: SparkSession, sf_dir: str, spec: FeatureSpec, ratio: float = 0.7) -> DataFrame:
    """The training rows of ``train_and_test`` where they are read, for what needs no order."""
    return hash_split(pruned(with_classes(prepared_frame(spark, sf_dir)), spec), KEY, ratio)[0]


def encoder_rows(spark: SparkSession, sf_dir: str, spec: FeatureSpec, ratio: float = 0.7) -> DataFrame:
    """The spec's inputs of the training rows, where they are read: labels' counts, ranges and
    deviations need neither the row key nor an order, so the rows are not spread."""
    train, _ = hash_split(pruned(prepared_frame(spark, sf_dir), spec), KEY, ratio)
    return train.select(*spec.input_columns)


def two_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with the order's date and priority: two date columns and two flags go through
    one preparation."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "M/d/yyyy").alias("order_date"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("is_urgent"))
    rows = raw_frame(spark, sf_dir).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    spec = PrepareSpec(columns=(*KEY, "is_discounted", "is_urgent", "order_date", "ship_date"),
                       flags=("is_discounted", "is_urgent"),
                       dates={"order_date": "order", "ship_date": "ship"})
    return prepare(rows, spec).drop("order_date", "ship_date")
