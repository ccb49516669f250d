"""The query against the SQL, which holds every template and rule, over notices, sentences in
prose, whole texts in several forms, and documents that inherit."""
import random

import duckdb
from conftest_llm import ODD_TEXTS, prose
from test_license_neighbours import NOTICES

from pricewise.llm import license_scan as s
from pricewise.llm.license_templates import FIRST, FULL, MORE


def documents():
    rng = random.Random(31)
    texts = list(ODD_TEXTS) + [prose(rng, 60) for _ in range(20)]
    for _, t in NOTICES:
        texts += [t, f"{prose(rng, 20)}. {t} {prose(rng, 20).capitalize()}", f"# {prose(rng, 5)}\n# " + t.replace(". ", ".\n# ")]
    for _, t in rng.sample(MORE, 60) + FIRST:
        texts.append(prose(rng, 15) + "\n\n" + t.replace(", ", ",\n") + "\n\n" + prose(rng, 30))
    for name, t in FULL:
        filled = f"Copyright (c) 2020 J. Roe\nAll rights reserved.\n\n{t}"
        texts += [filled, "int a;\n\n/*\n" + "\n".join(" * " + x for x in filled.split("\n")) + "\n */\n" + prose(rng, 40),
                  "\n\n".join(x for x in t.split("\n\n") if rng.random() < 0.9)]
    texts += ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
              f"the following conditions are met:\n{x}" for x in ("reproduce", "reproduce the advertising", "endorse reproduce", "")]
    return [(i, t, f"l{i % 3}", f"s{i % 17}") for i, t in enumerate(texts)]


def test_query_matches_sql_with_every_template(spark, tmp_path):
    df = spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string")
    df.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, s.op8_license_scan(spark, str(tmp_path))
                     .select("doc_id", "path", "licence", "cosine", "origin", "licence_dir").collect()))
    con = duckdb.connect()
    part = next((tmp_path / "documents.parquet").glob("part-*.parquet"))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{part}')")
    want = sorted(con.execute(s.OP8_SQL).fetchall())
    assert [(*r[:3], *r[4:]) for r in got] == [(*r[:3], *r[4:]) for r in want]
    assert all(abs((a[3] or 0) - (b[3] or 0)) < 2e-6 for a, b in zip(got, want))
    assert len({x[0] for x in FULL} & {r[2] for r in got}) > 20 and {r[4] for r in got} >= {"own", "directory"}
