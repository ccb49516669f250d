"""Fixed templates of the licence scan besides its first statements: statements, headers, titles
and SPDX lines of the usual licences, their whole texts (``licences/*.txt``), and the words
that tell neighbouring licences apart."""

from __future__ import annotations

import re
from pathlib import Path

#: Left out of whole texts, as every file has other names in them.
COPYRIGHT_LINE = (r"(?im)^[^\w\n]*(?:(?:portions )?copyright[ \t]*(?:\(c\)|\u00a9|[0-9]{4}|[<\[]).*"
                  r"|all rights reserved\W*)$")

_GPL_HEADER = ("This {what} is free software{semi} you can redistribute it and/or modify it under the terms of the "
               "GNU {name} as published by the Free Software Foundation{semi} either version {version} of the "
               "License, or (at your option) any later version.")
_GNU = [("GPL-1.0", "General Public License", "GPL", "1"), ("GPL-2.0", "General Public License", "GPL", "2"),
        ("GPL-3.0", "General Public License", "GPL", "3"), ("LGPL-2.0", "Library General Public License", "LGPL", "2"),
        ("LGPL-2.1", "Lesser General Public License", "LGPL", "2.1"),
        ("LGPL-3.0", "Lesser General Public License", "LGPL", "3"),
        ("AGPL-3.0", "Affero General Public License", "AGPL", "3")]
_CC = [("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
       ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
       ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")]
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:")
_SPDX = ["0BSD", "AGPL-3.0", "Apache-1.1", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause",
         "BSL-1.0", "CC0-1.0", "EPL-1.0", "EPL-2.0", "GFDL-1.2", "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0", "ISC",
         "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MIT-0", "MPL-1.1", "MPL-2.0", "Unlicense", "Zlib",
         *(f"CC-{k}-{v}" for k, _ in _CC for v in ("3.0", "4.0"))]


def _statements() -> list[tuple[str, str]]:
    out = []
    for label, name, short, version in _GNU:
        for what in ("program", "library", "file"):
            out.append((label, _GPL_HEADER.format(what=what, name=name, version=version,
                                                  semi=";")))
        out += [(label, f"This work is licensed under the GNU {name}, version {version}."),
                (label, f"Released under the GNU {name} v{version}."),
                (label, f"GNU {name} Version {version}"),
                (label, f"Licensed under the {short}v{version}."),
                (label, f"Licensed under the {short} version {version}.")]
    for kind, words in _CC:
        for v in ("3.0", "4.0"):
            out += [(f"CC-{kind}-{v}", f"Licensed under CC {kind} {v}."),
                    (f"CC-{kind}-{v}", f"This work is licensed under a Creative Commons {words} {v} International License."),
                    (f"CC-{kind}-{v}", f"Creative Commons {words} {v} International Public License"),
                    (f"CC-{kind}-{v}", f"{words} {v} International")]
    named = [("Apache-2.0", "Apache License, Version 2.0"), ("Apache-1.1", "Apache Software License, Version 1.1"),
             ("MIT", "MIT License"), ("ISC", "ISC License"), ("BSD-2-Clause", "BSD 2-Clause License"),
             ("BSD-3-Clause", "BSD 3-Clause License"), ("MPL-1.1", "Mozilla Public License Version 1.1"),
             ("MPL-2.0", "Mozilla Public License Version 2.0"), ("EPL-1.0", "Eclipse Public License v1.0"),
             ("EPL-2.0", "Eclipse Public License v2.0"), ("BSL-1.0", "Boost Software License, Version 1.0"),
             ("Zlib", "zlib License"), ("Artistic-2.0", "Artistic License 2.0"),
             ("CC0-1.0", "Creative Commons CC0 1.0 Universal")]
    for label, name in named:
        out += [(label, f"The {name}"), (label, f"Licensed under the {name}."), (label, f"Released under the {name}."),
                (label, f"This project is licensed under the terms of the {name}.")]
    out += [
        ("EPL-1.0", "Eclipse Public License - v 1.0"), ("EPL-2.0", "Eclipse Public License - v 2.0"),
        ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
         "except in compliance with the License."),
        ("EPL-1.0", "All rights reserved. This program and the accompanying materials are made available under the "
         "terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at "
         "http://www.eclipse.org/legal/epl-v10.html"),
        ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse "
         "Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
        ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the "
         "\"License\"); you may not use this file except in compliance with the License."),
        ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
         "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
        ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
         "is hereby granted."),
        ("Unlicense", "This is free and unencumbered software released into the public domain."),
        ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt "
         "or copy at http://www.boost.org/LICENSE_1_0.txt)"),
    ]
    return out + [(label, f"SPDX-License-Identifier: {label}") for label in _SPDX]


#: The same sentence opens all BSD licences: the clauses elsewhere in the file decide (``FILE_RULES``).
#: They stand before the other templates, as the first of equal cosines wins.
FIRST = [("BSD-2-Clause", _BSD), ("BSD-4-Clause", _BSD)]
MORE = _statements()
FULL = [(p.name.removesuffix(".txt"), re.sub(COPYRIGHT_LINE, "", p.read_text(encoding="utf-8")))
        for p in sorted((Path(__file__).parent / "licences").glob("*.txt"))]

#: By licence: groups of which a unit must hold a word each, where the template holds one, and
#: words that it must not hold, where the template doesn't.
_V1, _V2 = ["1", "1.0", "v1", "v1.0", "gplv1"], ["2", "2.0", "v2", "v2.0", "gplv2", "lgplv2"]
_V3 = ["3", "3.0", "v3", "v3.0", "gplv3", "lgplv3", "agplv3"]
_GPL = ["gpl", "gplv1", "gplv2", "gplv3", "general"]
_LGPL = ["lesser", "lgpl", "lgplv2", "lgplv2.1", "lgplv3"]
_AGPL = ["affero", "agpl", "agplv3", "remotely"]
_NOT_GPL = ["lesser", "lgpl", "lgplv2", "lgplv2.1", "lgplv3", "documentation", "fdl", *_AGPL]
RULES: dict[str, tuple[list[list[str]], list[str]]] = {
    "GPL-1.0": ([_GPL, _V1], _NOT_GPL), "GPL-2.0": ([_GPL, _V2], _NOT_GPL), "GPL-3.0": ([_GPL, _V3], _NOT_GPL),
    "LGPL-2.0": ([["library", "lgpl", "lgplv2"], _V2], ["lesser", *_AGPL]), "LGPL-2.1": ([_LGPL, ["2.1", "v2.1", "lgplv2.1"]], _AGPL),
    "LGPL-3.0": ([_LGPL, _V3], _AGPL), "AGPL-3.0": ([_AGPL, _V3], ["lesser", "lgpl"]),
    "GFDL-1.2": ([["documentation", "gfdl", "fdl"], ["1.2"]], []),
    "GFDL-1.3": ([["documentation", "gfdl", "fdl"], ["1.3"]], []),
    "Apache-1.1": ([["apache"], ["1.1", "v1.1"]], []), "Apache-2.0": ([["apache"], ["2", "2.0", "v2", "v2.0"]], []),
    "MPL-1.1": ([["mozilla", "mpl"], ["1.1", "v1.1"]], []),
    "MPL-2.0": ([["mozilla", "mpl"], ["2", "2.0", "v2", "v2.0"]], []),
    "EPL-1.0": ([["eclipse", "epl"], ["1", "1.0", "v1", "v1.0"]], []),
    "EPL-2.0": ([["eclipse", "epl"], ["2", "2.0", "v2", "v2.0"]], []),
    "BSL-1.0": ([["boost", "bsl"], ["1", "1.0", "v1", "v1.0"]], []),
    "Artistic-1.0-Perl": ([["artistic"]], ["2.0", "v2.0"]), "Artistic-2.0": ([["artistic"], ["2", "2.0", "v2.0"]], []),
    "MIT": ([["mit"], ["sublicense"], ["included"]], ["0", "attribution", "boost"]),
    "MIT-0": ([["mit"], ["0", "attribution"]], ["included"]),
    "ISC": ([["isc"], ["appear"], ["fee"]], []), "0BSD": ([["0bsd"], ["fee"]], ["appear"]),
    "BSD-2-Clause": ([["bsd"], ["2", "two", "simplified"], ["redistribution"]],
                     ["3", "4", "0", "endorse", "advertising", "patent", "views", "lbnl", "nuclear"]),
    "BSD-3-Clause": ([["bsd"], ["3", "three", "new", "revised"], ["redistribution"]],
                     ["4", "0", "advertising", "clear", "lbnl", "nuclear"]),
    "BSD-4-Clause": ([["bsd"], ["4", "original"], ["advertising"]], []),
    "Zlib": ([["zlib"], ["misrepresented"]], []), "Unlicense": ([["unlicense", "unencumbered"]], []),
    "CC0-1.0": ([["cc0"], ["1", "1.0"]], []),
    "Proprietary": ([["rights", "unauthorized"]], ["licence", "license", "licensed", "granted"]),
}
for _kind, _ in _CC:
    _nc, _sa, _nd = ["nc", "noncommercial"], ["sa", "sharealike"], ["nd", "noderivatives", "noderivs"]
    _has = [g for part, g in (("NC", _nc), ("SA", _sa), ("ND", _nd)) if part in _kind.split("-")]
    _not = [x for g in (_nc, _sa, _nd) if g not in _has for x in g]
    for _v in ("3.0", "4.0"):
        RULES[f"CC-{_kind}-{_v}"] = ([["cc", "creative", "creativecommons"], ["by", "attribution"], [_v], *_has], _not)
#: Instead, for whole texts: their clauses may have other numbers.
FULL_RULES: dict[str, tuple[list[list[str]], list[str]]] = {
    "BSD-2-Clause": ([["reproduce"]], ["endorse", "advertising"]), "BSD-3-Clause": ([["endorse"]], ["advertising"]),
    "BSD-4-Clause": ([["endorse"], ["advertising"]], []), "MIT": ([["sublicense"], ["included"]], []),
    "MIT-0": ([["sublicense"]], ["included"]), "ISC": ([["appear"], ["fee"]], []), "0BSD": ([["fee"]], ["appear"]),
}
#: Words that the file must hold, each, and must not hold, for the templates of ``FIRST``.
FILE_RULES = {"BSD-2-Clause": (["reproduce"], ["endorse", "advertising"]),
              "BSD-4-Clause": (["reproduce", "advertising"], [])}
