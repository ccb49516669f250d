"""Feature encoding (E1-E7): string index, categorical vector + VectorIndexer, one-hot
vectors, numeric vector + MinMaxScaler or StandardScaler, final concatenation.

All stages are Spark ML built-ins. Fits are distributed aggregates: label counts
(partial aggregation per task, so a hot label costs one row per task), bounded
distinct-value sets per slot, and a min/max or mean/deviation summary. What reaches the
driver is bounded (by a tree's maxBins and the spec's ``max_labels``): label lists are
checked against the limit with a HyperLogLog sketch *before* StringIndexer collects them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (MinMaxScaler, OneHotEncoder, StandardScaler, StringIndexer,
                                StringIndexerModel, VectorAssembler, VectorIndexer)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAT_VEC = "cat_vec"
CAT_IDX_VEC = "cat_index_vec"
NUM_VEC = "num_vec"
NORM_VEC = "scaled_vec"
FEATURES = "features"
INDEX_SUFFIX = "_idx"
HOT_SUFFIX = "_hot"

SKETCH_RSD = 0.05
#: Longest label list that is collected, unless a caller raises it.
MAX_LABELS = 100_000


class CardinalityError(ValueError):
    """A categorical column has more labels than the learner or driver allows."""


@dataclass(frozen=True)
class FeatureSpec:
    """Which prepared columns feed the model, and how.

    ``flags`` (0/1 ints) come first in the categorical vector, then the indexed
    string columns, then ``int_categorical`` (already-numeric categoricals such as
    date parts); the one-hot vectors of ``one_hot`` follow, then the scaled numerics.

    With ``drop_last`` a one-hot column has no slot for its last label (the rarest one, or the
    unseen ones under ``keep``), whose rows are zero there. ``scaler`` is ``minmax``, or
    ``standard`` for mean 0 and sample deviation 1; a constant column becomes 0.5 or 0.
    """
    label: str
    categorical: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    int_categorical: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    max_categories: int = 20
    handle_invalid: str = "error"      # error | keep | skip
    max_labels: int = MAX_LABELS       # refuse label lists longer than this
    one_hot: tuple[str, ...] = ()
    drop_last: bool = True
    scaler: str = "minmax"             # minmax | standard

    def __post_init__(self):
        if self.handle_invalid not in ("error", "keep", "skip"):
            raise ValueError("handle_invalid must be error, keep or skip")
        if self.scaler not in ("minmax", "standard"):
            raise ValueError("scaler must be minmax or standard")
        if not self.input_columns:
            raise ValueError("a FeatureSpec needs at least one input column")

    @property
    def indexed(self) -> tuple[str, ...]:
        return tuple(c + INDEX_SUFFIX for c in self.categorical)

    @property
    def labelled(self) -> tuple[str, ...]:
        """Columns whose label lists are learnt."""
        return self.categorical + self.one_hot

    @property
    def cat_inputs(self) -> tuple[str, ...]:
        return self.flags + self.indexed + self.int_categorical

    @property
    def slot_names(self) -> tuple[str, ...]:
        """Source column behind every slot of the final ``features`` vector. One-hot slots are
        known after fitting only: ``fitted_slot_names``."""
        if self.one_hot:
            raise ValueError("one-hot slots are named by fitted_slot_names")
        return self.input_columns

    @property
    def input_columns(self) -> tuple[str, ...]:
        return self.flags + self.categorical + self.int_categorical + self.one_hot + self.numeric


def encoder_stages(spec: FeatureSpec) -> list:
    stages: list = []
    if spec.labelled:
        stages.append(StringIndexer(inputCols=list(spec.labelled),
                                    outputCols=[c + INDEX_SUFFIX for c in spec.labelled],
                                    handleInvalid=spec.handle_invalid,
                                    stringOrderType="frequencyDesc"))
    # "keep" gives unseen labels an index; a missing number has none, so it stays an error
    vec_invalid = "skip" if spec.handle_invalid == "skip" else "error"
    parts = []
    if spec.cat_inputs:
        stages.append(VectorAssembler(inputCols=list(spec.cat_inputs), outputCol=CAT_VEC,
                                      handleInvalid=vec_invalid))
        stages.append(VectorIndexer(inputCol=CAT_VEC, outputCol=CAT_IDX_VEC,
                                    maxCategories=spec.max_categories,
                                    handleInvalid=spec.handle_invalid))
        parts.append(CAT_IDX_VEC)
    if spec.one_hot:
        hot = [c + HOT_SUFFIX for c in spec.one_hot]
        # unseen labels have an index of their own under "keep", so none is invalid here
        stages.append(OneHotEncoder(inputCols=[c + INDEX_SUFFIX for c in spec.one_hot], outputCols=hot,
                                    dropLast=spec.drop_last, handleInvalid="error"))
        parts += hot
    if spec.numeric:
        stages.append(VectorAssembler(inputCols=list(spec.numeric), outputCol=NUM_VEC,
                                      handleInvalid=vec_invalid))
        stages.append(MinMaxScaler(inputCol=NUM_VEC, outputCol=NORM_VEC) if spec.scaler == "minmax"
                      else StandardScaler(inputCol=NUM_VEC, outputCol=NORM_VEC, withMean=True, withStd=True))
        parts.append(NORM_VEC)
    stages.append(VectorAssembler(inputCols=parts, outputCol=FEATURES))
    return stages


def check_cardinality(df: DataFrame, cols: Sequence[str], limit: int | None) -> dict[str, int]:
    """One aggregate with an HLL sketch per column (partial aggregation, no row
    shuffle). Raises before any label list is collected to the driver."""
    if not cols or limit is None:
        return {}
    row = df.agg(*[F.approx_count_distinct(c, SKETCH_RSD).alias(c) for c in cols]).first()
    est = {c: int(row[c]) for c in cols}
    # 3 standard errors of the sketch above the limit before we call it a breach;
    # the exact count is checked again on the fitted label lists.
    too_many = {c: n for c, n in est.items() if n > limit * (1 + 3 * SKETCH_RSD) + 1}
    if too_many:
        raise CardinalityError(f"categorical columns exceed {limit} labels: {too_many}")
    return est


def label_limit_of(spec: FeatureSpec, label_limit: int | None = None) -> int:
    """The smaller of the learner's limit (maxBins) and the spec's."""
    return spec.max_labels if label_limit is None else min(label_limit, spec.max_labels)


def weighted_index(train: DataFrame, spec: FeatureSpec, weight: str) -> StringIndexerModel:
    """The StringIndexer of ``encoder_stages`` fitted on rows that stand for ``weight`` rows each:
    labels by falling frequency, equal ones in the order of Java's strings."""
    lists = []
    for c in spec.labelled:
        counts = train.select(F.col(c).cast("string").alias("label"), weight).dropna().groupBy("label") \
            .agg(F.sum(weight).alias("n")).collect()  # a row per label; their number is checked
        lists.append([r["label"] for r in sorted(counts, key=lambda r: (-r["n"], r["label"].encode("utf-16-be")))])
    return StringIndexerModel.from_arrays_of_labels(
        lists, inputCols=list(spec.labelled), outputCols=[c + INDEX_SUFFIX for c in spec.labelled],
        handleInvalid=spec.handle_invalid)


def fit_encoders(train: DataFrame, spec: FeatureSpec, label_limit: int | None = None,
                 precheck: bool = True, weight: str | None = None) -> PipelineModel:
    """Fit the encoder pipeline on training rows only. ``precheck=False`` when the
    caller already checked a superset of these rows (folds of a checked table). ``weight``
    names a column with the number of rows that a row stands for (categories and
    ranges don't depend on it; no standard scaler)."""
    limit = label_limit_of(spec, label_limit)
    if precheck:
        check_cardinality(train, spec.labelled, limit)
    stages = encoder_stages(spec)
    if weight and spec.scaler == "standard" and spec.numeric:
        raise ValueError("a standard scaler needs the rows themselves")
    if weight and spec.labelled:
        stages[0] = weighted_index(train, spec, weight)
    model = Pipeline(stages=stages).fit(train)
    if spec.labelled:
        for col, labels in zip(spec.labelled, model.stages[0].labelsArray):
            if len(labels) > limit:
                raise CardinalityError(f"column {col!r} has {len(labels)} labels > {limit}")
    return model


def fitted_slot_names(spec: FeatureSpec, model: PipelineModel) -> tuple[str, ...]:
    """Name of every slot of ``features``: the source column, or ``column=label`` of a one-hot
    slot (``column=`` for unseen labels)."""
    labels = dict(zip(spec.labelled, model.stages[0].labelsArray)) if spec.labelled else {}
    hot: list[str] = []
    for c in spec.one_hot:
        own = [*labels[c], ""] if spec.handle_invalid == "keep" else list(labels[c])
        hot += [f"{c}={x}" for x in (own[:-1] if spec.drop_last else own)]
    return spec.flags + spec.categorical + spec.int_categorical + tuple(hot) + spec.numeric


def nominal_slots(df: DataFrame, col: str = FEATURES) -> dict[int, int]:
    """{slot index: number of categories} from the vector's ML attribute metadata."""
    meta = df.schema[col].metadata.get("ml_attr", {})
    out: dict[int, int] = {}
    for attr in meta.get("attrs", {}).get("nominal", []):
        n = attr.get("num_vals") or len(attr.get("vals", []))
        for i in ([attr["idx"]] if "idx" in attr else []):
            out[i] = n
    return out


def check_bins(encoded: DataFrame, spec: FeatureSpec, max_bins: int) -> None:
    """Trees need maxBins >= categories of every nominal slot; fail early, by name."""
    names = spec.flags + spec.categorical + spec.int_categorical  # nominal slots come first
    bad = {names[i] if i < len(names) else str(i): n
           for i, n in nominal_slots(encoded).items() if n > max_bins}
    if bad:
        raise CardinalityError(f"maxBins={max_bins} is below the category count of {bad}")


def vector_columns(df: DataFrame, col: str, prefix: str, size: int, digits: int | None = None
                   ) -> list:
    """Vector column as ``size`` double columns ``{prefix}_{i}`` (JVM-side conversion)."""
    arr = vector_to_array(F.col(col))
    out = []
    for i in range(size):
        c = arr.getItem(i)
        if digits is not None:
            c = F.round(c, digits)
        out.append(c.alias(f"{prefix}_{i}"))
    return out
