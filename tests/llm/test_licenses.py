from __future__ import annotations

import duckdb
import pytest

from tallyroll.llm import licenses

SF = "/root/testdata/sf0.01"


def scan(spark, rows):
    documents = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS digest", "2 AS unit", "3 AS `a.b`")
    return sorted(tuple(row) for row in licenses.license_scan(documents).collect())


def test_whole_table_as_sql(spark):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    wanted = sorted(duck.sql(licenses.oracle_sql()).fetchall(), key=str)
    found = sorted((tuple(row) for row in licenses.license_scan(spark.read.parquet(f"{SF}/documents.parquet")).collect()), key=str)
    assert found == wanted
    assert sum(row[1] for row in found) > 20


MIT = dict(licenses.LICENSES[:1])["MIT"]


@pytest.mark.parametrize(
    ("text", "names", "whole"),
    [
        (MIT, "MIT", "MIT"),
        ("The MIT Licence (MIT)\n\nCopyright (c) 2020 Some One\nAll rights reserved.\n\n" + MIT.upper(), "MIT", "MIT"),
        (MIT.replace("sublicense", "sub-license").replace(" ", "\n  "), "MIT", "MIT"),
        (MIT + " And more.", "", None),
        ("Some prose.\nLicensed under the Apache Licence, version 2.0\nMore prose.", "Apache-2.0", None),
        ("Licensed under the Apache License, v 2.0", "Apache-2.0", "Apache-2.0"),
        ("# SPDX-License-Identifier: MIT\n\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0.", "CC-BY-NC-4.0,MIT", None),
        ("SPDX-License-Identifier: ISC", "ISC", "ISC"),
        ("Intro.\n\n" + MIT.split("\n\n")[0] + "\n \t\nReleased under\nthe MIT License.\n\nEnd.", "MIT", None),
        ("Copyright 2020 A\r\n(c) 2021 B\nReleased under the MIT License.", "MIT", "MIT"),
        ("Copyright of the text.\nReleased under the MIT License.", "MIT", None),
        ("We like the MIT License.", "", None),
        ("", "", None),
        (None, "", None),
        ("w " * 100_000, "", None),
    ],
)
def test_forms(spark, text, names, whole):
    assert scan(spark, [(1, text)]) == [(1, len(names.split(",")) if names else 0, names, whole)]


def test_rows(spark):
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License."), (1, "other"), (2, None)]
    assert scan(spark, rows) == [(1, 0, "", None), (1, 1, "MIT", "MIT"), (1, 1, "MIT", "MIT"), (2, 0, "", None)]
    documents = spark.createDataFrame([(None, "Licensed under CC BY 4.0.")], "doc_id long, text string")
    assert [tuple(row) for row in licenses.license_scan(documents).collect()] == [(None, 1, "CC-BY-4.0", "CC-BY-4.0")]
    assert licenses.license_scan(documents.limit(0)).count() == 0


def test_the_known_table_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(licenses, "MOST_KNOWN", 1)
    with pytest.raises(ValueError, match="known texts"):
        licenses.known_digests(spark)


TITLED_MIT = "MIT License\n\nCopyright (c) Jane Doe\n\n" + MIT
APACHE_HEADER = """/*
 * Copyright 2020 Some One
 *
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */"""


def test_full_texts_headers_runs_and_undated_copyright_lines(spark):
    cases = []
    for name in ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0-only", "GPL-3.0-only"):
        text = max((text for known, text in licenses.full_texts() if known == name), key=len)
        # The texts of the GPL end with the header of the "or later" form.
        names = f"{name},{name.replace('only', 'or-later')}" if name.startswith("GPL") else name
        cases.append((text, names, name))
        cases.append((f"Some prose.\n\n{text}\n\nMore prose.", names, None))
    cases += [
        (APACHE_HEADER, "Apache-2.0", "Apache-2.0"),
        (APACHE_HEADER + "\n\ncode", "Apache-2.0", None),
        (TITLED_MIT, "MIT", "MIT"),
        (TITLED_MIT.replace("Copyright (c)", "(c)"), "MIT", "MIT"),
        (TITLED_MIT.replace("Copyright (c)", "©"), "MIT", "MIT"),
        ("Intro.\n\n" + TITLED_MIT + "\n\nOutro.", "MIT", None),
        ("Intro.\n\n(c) Jane Doe\n" + MIT + "\n\nOutro.", "MIT", None),
        (("Intro.\n\n" + MIT + "\n\nOutro.").replace("\n", "\r\n"), "MIT", None),
        ("Intro.\n\n" + MIT.replace("sublicense", "sub\n\nlicense").replace("\n\n", "\n \n\n") + "\n\nOutro.", "MIT", None),
        ("Intro.\n\n" + MIT.replace(", ", ",\n\n") + "\n\nOutro.", "MIT", None),
        ("Intro.\n\n" + MIT.replace("copies of", "a copy of") + "\n\nOutro.", "", None),
        ("Intro.\n\n" + MIT + " More.\n\nOutro.", "", None),
        ("the\n\n" * 3000 + MIT, "MIT", None),
    ]
    wanted = [(number, len(list(filter(None, names.split(",")))), names, whole) for number, (_, names, whole) in enumerate(cases)]
    assert scan(spark, [(number, text) for number, (text, _, _) in enumerate(cases)]) == wanted


def test_reflowed_texts(spark):
    """A text in one line a paragraph is the same text."""
    cases = []
    for name in ("Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "CC0-1.0"):
        text = max((text for known, text in licenses.full_texts() if known == name), key=len)
        parts = []
        for part in text.split("\n\n"):
            lines = part.split("\n")
            stated = any(line.strip().lower().startswith(("copyright (c)", "copyright 2")) for line in lines)
            parts.append(part if stated else " ".join(part.split()))
        cases.append((name, "\n\n".join(parts)))
    found = scan(spark, [(number, text) for number, (_, text) in enumerate(cases)])
    assert [(row[0], row[3]) for row in found] == [(number, name) for number, (name, _) in enumerate(cases)]
