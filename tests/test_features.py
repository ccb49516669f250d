import pytest
from pyspark.sql import functions as F

from pricewise.operators.features import (CAT_IDX_VEC, FEATURES, NORM_VEC, CardinalityError,
                                          FeatureSpec, check_bins, check_cardinality,
                                          fit_encoders, nominal_slots, vector_columns)
from pricewise.operators.learners import make_learner
from pricewise.operators.tuning import plain_fit


def test_string_index_order_frequency_then_alphabet(spark):
    df = spark.createDataFrame([(x, 1.0) for x in "baacbd"], "c string, y double")
    enc = fit_encoders(df, FeatureSpec(label="y", categorical=("c",)))
    assert list(enc.stages[0].labelsArray[0]) == ["a", "b", "c", "d"]


def test_unseen_and_null_labels(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c string, y double")
    score = spark.createDataFrame([("a", 1.0), ("z", 3.0), (None, 4.0)], "c string, y double")
    with pytest.raises(Exception):
        fit_encoders(train, FeatureSpec(label="y", categorical=("c",))).transform(score).collect()
    keep = fit_encoders(train, FeatureSpec(label="y", categorical=("c",), handle_invalid="keep"))
    got = {r.c: r.c_idx for r in keep.transform(score).collect()}
    assert got["a"] == 0.0 and got["z"] == 2.0 and got[None] == 2.0
    skip = fit_encoders(train, FeatureSpec(label="y", categorical=("c",), handle_invalid="skip"))
    assert skip.transform(score).count() == 1


def test_vector_index_zero_first(spark):
    df = spark.createDataFrame([(0, 1.0), (-1, 1.0), (2, 1.0)], "v int, y double")
    enc = fit_encoders(df, FeatureSpec(label="y", int_categorical=("v",)))
    out = enc.transform(df).select("v", *vector_columns(enc.transform(df), CAT_IDX_VEC, "c", 1))
    assert {r.v: r.c_0 for r in out.collect()} == {0: 0.0, -1: 1.0, 2: 2.0}


def test_minmax_constant_and_out_of_range(spark):
    train = spark.createDataFrame([(7.0, 1.0, 1.0), (7.0, 3.0, 2.0)], "k double, x double, y double")
    score = spark.createDataFrame([(7.0, 5.0, 0.0)], "k double, x double, y double")
    enc = fit_encoders(train, FeatureSpec(label="y", numeric=("k", "x")))
    out = enc.transform(score)
    r = out.select(*vector_columns(out, NORM_VEC, "n", 2)).first()
    assert r.n_0 == 0.5 and r.n_1 == 2.0
    t = enc.transform(train)
    vals = [v for row in t.select(*vector_columns(t, NORM_VEC, "n", 2)).collect() for v in row]
    assert all(0.0 <= v <= 1.0 for v in vals)


def test_too_many_labels_for_max_bins_is_named(spark):
    rows = [(f"brand{i % 25:02d}", float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "brand string, y double")
    spec = FeatureSpec(label="y", categorical=("brand",))
    with pytest.raises(CardinalityError, match="brand"):
        plain_fit(df, spec, make_learner("dt", "y", maxBins=16))
    with pytest.raises(CardinalityError, match="brand"):
        check_cardinality(df, ["brand"], 10)
    model = plain_fit(df, spec, make_learner("dt", "y", maxBins=32))
    assert model.transform(df).count() == 200


def test_nominal_metadata_and_bins_check(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("b", 1, 2.0), ("c", 0, 3.0)],
                               "s string, f int, y double")
    spec = FeatureSpec(label="y", flags=("f",), categorical=("s",))
    enc = fit_encoders(df, spec)
    encoded = enc.transform(df)
    slots = nominal_slots(encoded, FEATURES)
    assert slots.get(1) == 3
    with pytest.raises(CardinalityError, match="'s'"):
        check_bins(encoded, spec, 2)


def test_null_numeric(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 2.0), (3.0, 3.0)], "x double, y double")
    with pytest.raises(Exception):
        fit_encoders(df, FeatureSpec(label="y", numeric=("x",))).transform(df).collect()
    enc = fit_encoders(df, FeatureSpec(label="y", numeric=("x",), handle_invalid="skip"))
    assert enc.transform(df).count() == 2


def test_csv_inference(spark, tmp_path):
    from pricewise.sources.files import read_csv
    p = tmp_path / "in.csv"
    p.write_text("flag,n,s\nTrue,1,4/16/2022\nFALSE,,x\n")
    df = read_csv(spark, str(p))
    assert dict(df.dtypes) == {"flag": "boolean", "n": "int", "s": "string"}
    assert [tuple(r) for r in df.collect()] == [(True, 1, "4/16/2022"), (False, None, "x")]


def test_explicit_schema_scan(spark, tmp_path):
    from pricewise.sources.files import read_csv
    p = tmp_path / "in.csv"
    p.write_text("3,5,AA,10,20,-1,4\n")
    schema = ("DayofMonth int, DayOfWeek int, Carrier string, OriginAirportID int, "
              "DestAirportID int, DepDelay int, ArrDelay int")
    df = read_csv(spark, str(p), schema=schema, header=False)
    assert df.first().Carrier == "AA" and df.first().ArrDelay == 4


def test_label_limit_is_opt_in(spark):
    df = spark.range(12_000).selectExpr("concat('c', id) as c", "cast(id as double) as y")
    enc = fit_encoders(df, FeatureSpec(label="y", categorical=("c",)))
    assert len(enc.stages[0].labelsArray[0]) == 12_000
    with pytest.raises(CardinalityError):
        fit_encoders(df, FeatureSpec(label="y", categorical=("c",), max_labels=10_000))


def test_keep_is_for_labels_only(spark):
    """A missing number has no index to keep: an error rather than a NaN in the vector."""
    df = spark.createDataFrame([("a", 1.0, 1.0), (None, None, 2.0)], "c string, x double, y double")
    spec = FeatureSpec(label="y", categorical=("c",), numeric=("x",), handle_invalid="keep")
    enc = fit_encoders(df.filter("x is not null"), spec)
    with pytest.raises(Exception, match="null"):
        enc.transform(df).collect()
