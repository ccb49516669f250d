from pyspark.sql import functions as F

from pricewise.functions.columns import date_parts, epoch_seconds, flag_to_int, hash_value
from pricewise.operators.prepare import PrepareSpec, cast_flags, prepare, project, rename


def test_date_parts_mixed_formats(spark):
    df = spark.createDataFrame([("4/16/2022",), ("2022-04-16",), ("",), (None,), ("12/1/1999",)],
                               "d string")
    rows = df.select("d", *[c.alias(n) for n, c in date_parts("d", "x").items()]).collect()
    got = {r.d: (r.x_month, r.x_day, r.x_year) for r in rows}
    assert got["4/16/2022"] == (4, 16, 2022)
    assert got["12/1/1999"] == (12, 1, 1999)
    assert got["2022-04-16"] == (None, None, None)
    assert got[""] == (None, None, None)
    assert got[None] == (None, None, None)


def test_flag_cast_keeps_null(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert [r[0] for r in df.select(flag_to_int("b")).collect()] == [1, 0, None]


def test_hash_value_is_deterministic_and_matches_duckdb(spark):
    import duckdb
    rows = [(k, n) for k in (1, 7, 5979, 123456789) for n in (1, 2, 7)]
    df = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int")
    got = {(r[0], r[1]): r[2] for r in df.select("l_orderkey", "l_linenumber",
                                                  hash_value(["l_orderkey", "l_linenumber"])).collect()}
    con = duckdb.connect()
    for (k, n), b in got.items():
        want = con.execute(
            "SELECT CAST(('0x' || substr(md5(?::VARCHAR || '-' || ?::VARCHAR), 1, 8)) AS BIGINT)",
            [k, n]).fetchone()[0]
        assert b == want
    again = df.select(hash_value(["l_orderkey", "l_linenumber"])).collect()
    assert sorted(r[0] for r in again) == sorted(got.values())


def test_epoch_seconds_is_zone_free(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'1995-01-02 03:04:05' AS t")
    assert df.select(epoch_seconds("t")).first()[0] == 789015845


def test_prepare_spec(spark):
    df = spark.createDataFrame([("a", True, "4/16/2022", 1.5, "x")],
                               "s string, f boolean, d string, y double, unused string")
    out = prepare(df, PrepareSpec(columns=("s", "f", "d", "y"), flags=("f",), dates={"d": "dd"},
                                  renames={"y": "trueLabel"}))
    assert out.columns == ["s", "f", "d", "trueLabel", "dd_month", "dd_day", "dd_year"]
    r = out.first()
    assert (r.f, r.dd_month, r.dd_day, r.dd_year, r.trueLabel) == (1, 4, 16, 2022, 1.5)
    assert dict(out.dtypes)["f"] == "int"
    import pytest
    with pytest.raises(KeyError):
        project(df, ["nope"])
    assert cast_flags(df, []) is df and rename(df, {}) is df
