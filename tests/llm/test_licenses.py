"""Notices as the public licence texts state them, wrapped at several columns, plain or as comments."""

import textwrap

import duckdb
import pandas as pd
import pytest

from tideline.llm import licenses, queries

MIT = [
    "MIT License",
    "Copyright (c) 2024 The Authors",
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and '
    'associated documentation files (the "Software"), to deal in the Software without restriction, '
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
    "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
    "furnished to do so, subject to the following conditions:",
    "The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software.",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
    "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
]
APACHE = [
    "Copyright 2024 The Authors",
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
    "compliance with the License. You may obtain a copy of the License at",
    "    http://www.apache.org/licenses/LICENSE-2.0",
    "Unless required by applicable law or agreed to in writing, software distributed under the License "
    'is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
    "implied. See the License for the specific language governing permissions and limitations under the "
    "License.",
]


def free(name, licence, version, see):
    return [
        f"This {name} is free software: you can redistribute it and/or modify it under the terms of the "
        f"{licence} as published by the Free Software Foundation, {version}.",
        f"This {name} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        f"{see} for more details.",
    ]


LATER = "either version {} of the License, or (at your option) any later version"
GPL, LGPL = "GNU General Public License", "GNU Lesser General Public License"
AGPL = "GNU Affero General Public License"
CONDITIONS = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions "
    "and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.",
]
ENDORSE = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission."
)
DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR '
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
)
NOTICES = {
    ("mit-full-text", "MIT"): MIT,
    ("apache-full-notice", "Apache-2.0"): APACHE,
    ("gpl-3.0-or-later-notice", "GPL-3.0-or-later"): free("program", GPL, LATER.format(3), GPL),
    ("gpl-2.0-or-later-notice", "GPL-2.0-or-later"): free("program", GPL, LATER.format(2), GPL),
    ("lgpl-2.1-or-later-notice", "LGPL-2.1-or-later"): free("library", LGPL, LATER.format("2.1"), LGPL),
    ("lgpl-3.0-or-later-notice", "LGPL-3.0-or-later"): free("library", LGPL, LATER.format(3), LGPL),
    ("agpl-3.0-or-later-notice", "AGPL-3.0-or-later"): free("program", AGPL, LATER.format(3), AGPL),
    ("gpl-2.0-only-notice", "GPL-2.0-only"): free("program", GPL, "version 2 of the License", GPL),
    ("gpl-3.0-only-notice", "GPL-3.0-only"): free("program", GPL, "version 3 of the License", GPL),
    ("mpl-notice", "MPL-2.0"): [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
        "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ],
    ("bsd-3-text", "BSD-3-Clause"): [*CONDITIONS, ENDORSE, DISCLAIMER],
    ("bsd-2-text", "BSD-2-Clause"): [*CONDITIONS, DISCLAIMER],
    ("isc-text", "ISC"): [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
        "in all copies.",
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ],
    ("0bsd-text", "0BSD"): [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted.",
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ],
    ("unlicense-line", "Unlicense"): [
        "This is free and unencumbered software released into the public domain."
    ],
}
TAGS = {
    "// SPDX-License-Identifier: BSD-3-Clause\npackage a;": {"BSD-3-Clause"},
    "# SPDX-License-Identifier: GPL-2.0-or-later": {"GPL-2.0-or-later"},
    "/* SPDX-License-Identifier: (MIT OR Apache-2.0) */": {"MIT", "Apache-2.0"},
    "SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0": {"GPL-2.0-only"},
    "SPDX-License-Identifier: GPL-3.0-or-later OR MPL-2.0 AND ISC": {"GPL-3.0-or-later", "MPL-2.0", "ISC"},
    "SPDX-License-Identifier: Something-1.0": set(),
}


def written(paragraphs, width, mark):
    """Paragraphs wrapped at a column, each line after a comment mark."""
    lines = []
    for paragraph in paragraphs:
        lines += [*textwrap.wrap(paragraph, width, break_long_words=False, break_on_hyphens=False), ""]
    return "\n".join(f"{mark}{x}".rstrip() for x in lines)


def texts():
    out, wanted = [], []
    for rule, paragraphs in NOTICES.items():
        for width in (40, 60, 80, 10_000):
            for mark in ("", "# ", " * ", "// "):
                out.append(f"def f(x):\n    return x\n\n{written(paragraphs, width, mark)}\n\nimport os\n")
                wanted.append({rule})
    return out, wanted


def test_real_notices_however_wrapped(make):
    some, wanted = texts()
    got = [set() for _ in some]
    for r in licenses.scan(make(some)).collect():
        got[r.doc_id].add((r.rule, r.license))
    wrong = [(some[i], got[i]) for i in range(len(some)) if got[i] != wanted[i]]
    assert not wrong, wrong[:2]


def test_headings_and_crlf(make):
    body = written(MIT[2:], 60, "")
    some = [
        f"MIT License\nCopyright (c) 2024 The Authors\n{body}",
        f"Copyright 2024\n{written(APACHE[1:], 70, '')}",
        written(MIT, 60, "").replace("\n", "\r\n"),
        "This file is licensed under the Apache License,\nVersion 2.0",
    ]
    got = sorted((r.doc_id, r.rule) for r in licenses.scan(make(some)).collect())
    assert got == [(0, "mit-full-text"), (1, "apache-full-notice"), (2, "mit-full-text"), (3, "apache-line")]


@pytest.mark.parametrize("text", list(TAGS))
def test_tags(make, text):
    assert {r.license for r in licenses.scan(make([text])).collect()} == TAGS[text]


def test_sql_on_notices(make, odd):
    some = [*texts()[0], *TAGS, *odd[0]]
    rows = licenses.scan(make(some)).toPandas()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(some)), "text": some}))
    sql = con.execute(queries.ORACLES["op2_license_scan"]).fetchdf()
    names = sorted(rows.columns)
    assert sorted(sql.columns) == names
    assert sorted(map(tuple, rows[names].values)) == sorted(map(tuple, sql[names].values))


def test_identifiers_are_told_apart():
    singles = [r.sentences for r in licenses.RULES if len(r.sentences) == 1]
    assert len(singles) == len(set(singles))
    assert len({r.name for r in licenses.RULES}) == len(licenses.RULES)
    given = set("".join(licenses.SENTENCES.values()))
    assert all(set(r.sentences) <= given for r in licenses.RULES)
