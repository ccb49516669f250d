import pytest

from pricewise.operators import tuning as tu
from pricewise.operators.learners import make_learner
from pricewise.plans import lineitem as li
from pricewise.session import scratch_path
from pricewise.session import _scratch, remove_scratch
from pricewise.sources.files import read_csv, register_view, sql_scan, write_csv, write_table
from pricewise.streaming.scoring import read_sink, run_to_parquet, score_stream


def test_round_trips(spark, sf_small):
    df = li.prepared_frame(spark, sf_small)
    n = df.count()
    t = write_table(df, "t_roundtrip", scratch_path(spark, "t2"))
    assert spark.table(t).count() == n
    assert sql_scan(spark, register_view(df, "v_roundtrip")).count() == n
    c = write_csv(li.raw_frame(spark, sf_small), scratch_path(spark, "c"))
    back = read_csv(spark, c)
    assert back.count() == n and dict(back.dtypes)["is_discounted"] == "boolean"


def test_stream_scoring_equals_batch(spark, sf_small):
    data = li.prepared_frame(spark, sf_small)
    model = tu.plain_fit(data, li.CELL_SPEC, make_learner("dt", li.LABEL, maxDepth=5))
    with pytest.raises(ValueError):
        score_stream(model, data, li.KEY, li.LABEL)
    base = scratch_path(spark, "stream")
    stream = li.prepared_stream(spark, sf_small)
    out = run_to_parquet(score_stream(model, stream, li.KEY, li.LABEL), f"{base}/out",
                         f"{base}/ck")
    streamed = spark.read.parquet(out)
    batch = model.transform(li.prepared_frame(spark, sf_small)).select(*li.KEY, "prediction")
    assert streamed.count() == batch.count()
    diff = streamed.select(*li.KEY, "prediction").exceptAll(batch)
    assert diff.count() == 0
    # restart with the same checkpoint: nothing new to process, nothing written twice
    run_to_parquet(score_stream(model, li.prepared_stream(spark, sf_small), li.KEY, li.LABEL),
                   f"{base}/out", f"{base}/ck")
    assert spark.read.parquet(out).count() == batch.count()


def test_stream_reads_a_folder_of_part_files_and_nothing_else(spark, sf_small, tmp_path):
    table = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    table.repartition(4).write.parquet(f"{tmp_path}/lineitem.parquet")
    table.limit(9).write.parquet(f"{tmp_path}/lineitem_old.parquet")
    stream = li.prepared_stream(spark, str(tmp_path))
    out = run_to_parquet(stream, f"{tmp_path}/out", f"{tmp_path}/ck")
    streamed = read_sink(spark, out, stream.schema)
    assert streamed.count() == table.count()
    assert streamed.exceptAll(li.prepared_frame(spark, str(tmp_path))).count() == 0


def test_a_sink_without_rows_is_an_empty_frame(spark, sf_small, tmp_path):
    stream = li.prepared_stream(spark, sf_small).filter("l_orderkey < 0")
    out = run_to_parquet(stream, f"{tmp_path}/out", f"{tmp_path}/ck")
    back = read_sink(spark, out, stream.schema)
    assert back.count() == 0 and back.columns == stream.columns


def test_scratch_is_removed(spark, sf_small):
    import os
    path = scratch_path(spark, "gone")
    write_csv(li.raw_frame(spark, sf_small), path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    assert remove_scratch(spark) >= 1 and not os.path.exists(local) and not _scratch
