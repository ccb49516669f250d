import math
import random
import re

import pytest

from conftest_llm import ODD_TEXTS, prose
from pricewise.llm import license_scan as s


def brute(rows):
    rows = [(p or "", t or "") for p, t in rows]
    texts = dict(rows)  # paths are distinct here
    n, known = len(rows), s.vocabulary(s.TEMPLATES)
    held = [set(s.words_of(t)) for _, t in rows]
    idf = {w: math.log((1 + n) / (1 + sum(w in h for h in held))) + 0.1 for w in known}
    weights = s.template_weights(s.TEMPLATES, idf)
    own = {}
    for path, text in texts.items():
        units = text.split("\n") + [p for p in re.split(r"\n[ \t\r]*\n\s*", text) if "\n" in p]
        best = None
        for u in units:
            w = s.words_of(u)
            v = {x: (1 + math.log(w.count(x))) * idf.get(x, math.log(1 + n) + 0.1) for x in set(w)}
            norm = math.sqrt(sum(x * x for x in v.values()))
            dots = [sum(v[x] * t[x] for x in v if x in t) for t in weights]
            if norm and max(dots) / norm >= s.THRESHOLD:
                name = s.TEMPLATES[dots.index(max(dots))][0]
                found = (round(max(dots) / norm, 9), name, len(w))
                best = max(best, found) if best else found
        if best:
            own[path] = (best[1], best[0], best[2] >= 0.5 * len(s.words_of(text)))
    licensed = {}
    for path, (name, cos, whole) in own.items():
        if whole or re.match(s.LICENCE_NAME, path.rsplit("/", 1)[-1]):
            d = path.rsplit("/", 1)[0] if "/" in path else ""
            licensed[d] = min(licensed.get(d, (9, "")), (-cos, path, name))
    out = {}
    for path in texts:
        if path in own:
            out[path] = (own[path][0], "own", None)
            continue
        d = path.rsplit("/", 1)[0] if "/" in path else ""
        while d and d not in licensed:
            d = d.rsplit("/", 1)[0] if "/" in d else ""
        out[path] = (licensed[d][2], "directory", d) if d in licensed else (None, "none", None)
    return out


def corpus():
    rng = random.Random(5)
    headers = [t for _, t in s.TEMPLATES]
    rows = []
    for i in range(120):
        d = "/".join(rng.choice("abc") for _ in range(rng.randrange(4)))
        text = prose(rng, rng.randrange(30, 60)).replace(" ", "\n", 3)
        if i % 4 == 0:
            text = rng.choice(headers) + "\n" + text
        if i % 9 == 0:
            text = text + "\n\n# " + rng.choice(headers).replace(", ", ",\n# ") + "\n"
        rows.append((f"{d}/f{i}" if d else f"f{i}", text))
    rows += [("a/LICENSE", headers[4] + "\n" + prose(rng, 80)), ("a/b/x", headers[0]), ("c/COPYING.txt", "All rights reserved."),
             ("c/c/LICENSE.md", "nothing here"), ("a/c/licensed", headers[6] + "\n" + prose(rng, 90)), (None, "no path")]
    return rows + [(f"odd/{i}", t) for i, t in enumerate(ODD_TEXTS)]


def test_matches_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "path string, text string, word int, licence string")
    got = s.scan(df.repartition(3)).collect()
    assert len(got) == len(rows) and all(r.word == 7 for r in got)
    want = brute(rows)
    assert {r.path: (r.licence, r.origin, r.licence_dir) for r in got} == want
    assert {w[1] for w in want.values()} == {"own", "directory", "none"}


def test_repeated_rows_root_and_empty(spark):
    rows = [("LICENSE", "Released under the MIT License."), ("x/y", "text"), ("x/y", "text"), ("/abs/z", "text")]
    df = spark.createDataFrame(rows, "path string, text string")
    got = sorted((r.path, r.licence, r.origin, r.licence_dir) for r in s.scan(df).collect())
    assert got == [("/abs/z", "MIT", "directory", ""), ("LICENSE", "MIT", "own", None),
                   ("x/y", "MIT", "directory", ""), ("x/y", "MIT", "directory", "")]
    assert s.scan(df.limit(0)).count() == 0


def test_no_python_on_the_executors(spark, sf_small):
    plan = s.op8_license_scan(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|BatchEval", plan)


def test_units_without_an_anchor_stay_below():
    idf = {w: 1.0 + (hash(w) % 7) for w in s.vocabulary(s.TEMPLATES)}
    weights = s.template_weights(s.TEMPLATES, idf)
    anchors = set(s.anchors_of(weights, 0.6))
    for w in weights:
        rest = [v for x, v in w.items() if x not in anchors]
        assert math.sqrt(sum(v * v for v in rest)) < 0.6


def test_statements_are_told_apart(spark):
    rows = [(f"d{i}/f", prose(random.Random(i), 40) + "\n" + t) for i, t in enumerate([t for _, t in s.TEMPLATES])]
    got = {r.path: r.licence for r in s.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert [got[f"d{i}/f"] for i in range(len(rows))] == [n for n, _ in s.TEMPLATES]
