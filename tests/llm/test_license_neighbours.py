"""Notices that are no template verbatim, whole texts, and the words that tell licences apart."""
import re

import pytest

from pricewise.llm import license_scan as s
from pricewise.llm.license_templates import FULL

NOTICES = [
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, "
     "or (at your option) any later version. Frobnicate is part of it."),
    ("AGPL-3.0", "Frob is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
     "your option) any later version."),
    ("LGPL-3.0", "Frob is covered by the GNU Lesser General Public License, version 3."),
    ("GPL-2.0", "licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "// SPDX-License-Identifier: GPL-2.0-only"),
    ("ISC", "// SPDX-License-Identifier: ISC"),
    ("LGPL-2.1", "# SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("AGPL-3.0", "# SPDX-License-Identifier: AGPL-3.0-only"),
    ("BSD-2-Clause", "# SPDX-License-Identifier: BSD-2-Clause"),
    ("Unlicense", "# SPDX-License-Identifier: Unlicense"),
    ("EPL-2.0", "/* SPDX-License-Identifier: EPL-2.0 */"),
    ("CC-BY-ND-4.0", "This photo is licensed under CC BY-ND 4.0."),
    ("CC-BY-SA-4.0", "Graphosaurus is licensed under a\nCreative Commons Attribution-ShareAlike 4.0 International "
     "License."),
    ("CC-BY-3.0", "This text is licensed under a Creative Commons Attribution 3.0 International License."),
    ("EPL-2.0", "The text of the Eclipse Public License - v 2.0"),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("Apache-2.0", "The parser reads all of it, and the writer repeats it in the same order as it was read. The code "
     "here is licensed under the Apache License, Version 2.0. Nothing else is to be said of the many other parts."),
    (None, "SPDX-License-Identifier: WTFPL"),
    (None, "SPDX-License-Identifier: Apache-1.0"),
    (None, "Licensed under the Apache License, Version 1.0."),
    (None, "This work is licensed under the GNU General Public License, version 9."),
    ("MIT", "Licensed under the MIT license."),
]


def licences(spark, texts):
    df = spark.createDataFrame([(f"d{i}/f", t) for i, t in enumerate(texts)], "path string, text string")
    got = {r.path: (r.licence, r.origin) for r in s.scan(df).collect()}
    return [got[f"d{i}/f"] for i in range(len(texts))]


def test_notices(spark):
    got = licences(spark, [f"alpha beta\n{t}\ngamma delta" for _, t in NOTICES])
    assert [(g[0], t) for g, (_, t) in zip(got, NOTICES)] == NOTICES


def test_whole_texts_as_files_and_in_comments(spark):
    cases = []
    for name, text in FULL:
        filled = f"Copyright (c) 2021 Jane Roe\nAll rights reserved.\n\n{text}\n"
        cases += [(name, filled), (name, "\r\n".join(filled.split("\n"))),
                  (name, "/*\n" + "\n".join(" * " + x for x in filled.split("\n")) + "\n */\n" + "int a;\n\n" * 20)]
    got = licences(spark, [t for _, t in cases])
    assert [(i, g[0]) for i, g in enumerate(got)] == [(i, n) for i, (n, _) in enumerate(cases)]


@pytest.mark.parametrize("name", ["LGPL-2.1", "AGPL-3.0", "BSD-2-Clause", "GPL-2.0", "MPL-1.1", "ISC"])
def test_a_text_without_template_is_not_its_neighbour(spark, monkeypatch, name):
    """Whole texts that are no template get no licence (or their own, by a statement in them), never
    that of a similar text."""
    monkeypatch.setattr(s, "FULL", [x for x in FULL if x[0] != name])
    (licence, _), = licences(spark, [re.sub(r"(?i)all\s+rights\s+reserved", "", dict(FULL)[name])])
    assert licence in (None, name)
