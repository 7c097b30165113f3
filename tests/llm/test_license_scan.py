import re
import sys
import textwrap
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from compare import difference  # noqa: E402
from helpers import clashing, no_docs, odd_docs  # noqa: E402
from tidegauge.llm import license_scan, license_texts  # noqa: E402
from tidegauge.llm.queries import ORACLES  # noqa: E402

MIT = license_texts.KNOWN[0][1]
BSD = license_texts.KNOWN[3][1]


def scanned(spark, texts, known=None):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [tuple(r)[2:] for r in license_scan.scan(docs, known).orderBy("doc_id").collect()]


def test_every_known_text_is_found(spark):
    rows = scanned(spark, [text for _, text in license_texts.KNOWN])
    assert [r[0] for r in rows] == [name for name, _ in license_texts.KNOWN]


@pytest.mark.parametrize("change", [
    str.upper, lambda t: t.replace(" ", "  \t "), lambda t: "Copyright (c) 2001 Some Body\n" + t,
    lambda t: t + "\n(c) 2002 Other\n\n  ALL RIGHTS RESERVED.", lambda t: t.replace(",", " ; ").replace('"', "''"),
    lambda t: t.replace("copyright holder", "copyright owner").replace("license", "licence"),
])
def test_spellings_case_punctuation_and_copyright_lines(spark, change):
    assert [r[0] for r in scanned(spark, [change(MIT), change(BSD)])] == ["MIT", "BSD-3-Clause"]


@pytest.mark.parametrize("first", [
    "Copyright (c) 2020 X", "Copyright(c) 2020 X", "Copyright: X", "(c) 2020 X", "( C ) 2020 X", "© X", "ALL RIGHTS RESERVED",
    "Copyright The X Authors. All rights reserved.",
])
def test_copyright_lines_of_commented_headers(spark, first):
    headers = []
    for text in (MIT, BSD):
        lines = [first, "", *text.split("\n")]
        headers += [
            "\n".join(f"{mark} {line}" for line in lines) for mark in ("#", "//", " *", "--", ";;", "%", "\t\t#")
        ] + ["/*\n" + "\n".join(f" * {line}" for line in lines) + "\n */"]
    want = ["MIT"] * 8 + ["BSD-3-Clause"] * 8
    assert [r[0] for r in scanned(spark, headers)] == want
    rows = scanned(spark, [f"#!/bin/sh\n\n{header}\n\nrun = 1" for header in headers])
    assert [(r[0], r[2]) for r in rows] == [(None, name) for name in want]


@pytest.mark.parametrize("width", [40, 60, 72, 90])
def test_wrapped_lines_of_prose_are_no_copyright_lines(spark, width):
    texts = [license_texts.KNOWN[0][1], BSD, *(published(n) for n in ("Apache-2.0", "GPL-3.0", "MPL-2.0", "LGPL-2.1"))]
    wrapped = [
        "\n\n".join(textwrap.fill(" ".join(p.split()), width, break_long_words=False, break_on_hyphens=False)
                    if not re.search(r"(?i)(copyright|\(c\)) +[\d<[]", p) else p for p in text.split("\n\n"))
        for text in texts
    ]
    commented = ["\n".join(f" * {line}" for line in text.split("\n")) for text in wrapped]
    assert [r[0] for r in scanned(spark, wrapped + commented)] == [
        "MIT", "BSD-3-Clause", "Apache-2.0", "GPL-3.0", "MPL-2.0", "LGPL-2.1"] * 2


def test_other_texts_are_left_alone(spark):
    rows = scanned(spark, [MIT + " or not", MIT.replace("free of charge", "for a charge"), "a licence", "x"])
    assert rows == [(None, 0, None)] * 4


def test_lines_and_paragraphs_inside_documents(spark):
    line = "Released under the MIT License."
    notice = license_texts.KNOWN[6][1].split("\n\n")
    known = spark.createDataFrame([("two", "first line\nsecond line"), ("MIT", line)], "license_id string, text string")
    texts = [
        f"prose\n{line}\nmore", f"{line}\n{line}", "prose\n\nFirst line.\nSecond, line\n\nmore prose",
        "first line second line\nprose", "first line\nsecond line", "\n".join(notice), f"{line} and more",
    ]
    assert scanned(spark, texts, known) == [
        (None, 1, "MIT"), (None, 2, "MIT"), (None, 1, "two"), (None, 1, "two"), ("two", 1, "two"),
        (None, 0, None), (None, 0, None),
    ]


def published(name):
    return (Path(license_texts.__file__).parent / "licenses" / f"{name}.txt").read_text("utf-8")


def test_whole_licences_are_found(spark):
    names = sorted(p.stem for p in (Path(license_texts.__file__).parent / "licenses").iterdir())
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense", "CC0-1.0"} <= set(names)
    terms = published("Apache-2.0").split("APPENDIX")[0]
    titled = "The MIT License (MIT)\n\nCopyright (c) 2020 X\n\n" + license_texts.KNOWN[1][1]
    texts = [published(n) for n in names] + [terms, titled, published("GPL-3.0").replace("https:", "http:")]
    assert [r[0] for r in scanned(spark, texts)] == [*names, "Apache-2.0", "MIT", "GPL-3.0"]
    assert scanned(spark, [published("GPL-3.0").replace("freedom", "liberty", 1)])[0][0] is None


def test_families_of_notices_and_identifier_lines(spark):
    lines = {
        "Licensed under CC BY 4.0.": "CC-BY-4.0", "SPDX-License-Identifier: GPL-3.0-or-later": "GPL-3.0-or-later",
        "This project is licensed under the MIT License": "MIT", "// SPDX-License-Identifier: MPL-2.0": "MPL-2.0",
        "SPDX-License-Identifier: MIT OR Apache-2.0": "Apache-2.0 OR MIT",
        "/* SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note */": "GPL-2.0 WITH Linux-syscall-note",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
        "Released under the GNU Affero General Public License, version 3 or later.": "AGPL-3.0-or-later",
        "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0",
        "Licensed under GPLv3+": "GPL-3.0", "Licensed under the GPL-2.0 only": "GPL-2.0-only",
        "Licensed under some other terms.": None, "SPDX-License-Identifier: None-Of-Them": None,
    }
    rows = scanned(spark, [f"some prose\n\n{line}\n\nmore" for line in lines])
    assert rows == [(None, int(name is not None), name) for name in lines.values()]


def test_sql_knows_all_texts_and_copyright_lines(spark):
    whole = sorted({text for _, text in license_texts.whole_texts() + license_texts.headers()})
    sentences = [text for _, text in license_texts.sentences()[::97] + license_texts.spdx_lines()[::29]]
    firsts = [
        "Copyright (c) 2020 X", "Copyright(c) 2020 X", "Copyright: X", "( C ) 2020 X", "© X", "ALL RIGHTS RESERVED",
        "Copyright holder: X", "copyright holders and contributors", "copyright, and or", "copyrighted", "copyright",
        "(c) you must", "(c) under", "(c) underneath", "copyright-free", "copyright.", "Copyright notice", "copyright - X",
    ]
    commented = ["\n".join(f"{mark} {line}" for line in [first, *text.split("\n")])
                 for first in firsts for mark in ("#", "//", " *") for text in (MIT, BSD)]
    wrapped = ["\n".join(textwrap.wrap(text, width)) for text in whole[:12] for width in (40, 72)]
    texts = [*whole, "\n".join(sentences), *commented, *wrapped, *firsts, "", None, "prose\n\n" + MIT + "\n\nprose"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    engine = duckdb.connect()
    engine.register("documents", docs.toPandas())
    assert difference(license_scan.scan(docs), engine, ORACLES["op1_license_scan"]) is None
    found = scanned(spark, texts)
    assert sum(r[0] is not None for r in found) >= len(whole) and max(r[1] for r in found) == len(sentences)


def test_known_texts_fit_the_broadcast():
    known = license_texts.known_texts()
    assert len(known) <= license_scan.MOST_KNOWN and set(license_texts.KNOWN) <= set(known)


def test_odd_rows(spark):
    docs = clashing(odd_docs(spark), "digest", "license_id", "mark", "kind", "units")
    rows = license_scan.scan(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in rows if r.doc_id is not None) == sorted(
        (r.doc_id is None, r.doc_id) for r in docs.collect() if r.doc_id is not None)
    assert len(rows) == docs.count() and all(r.text_license is None and r.notices == 0 for r in rows)
    empty = {r.text_digest for r in rows if r.doc_id in (1, 2, 3)}
    assert empty == {"d41d8cd98f00b204e9800998ecf8427e"}
    assert license_scan.scan(no_docs(spark)).collect() == []


def test_repeated_rows_count_their_own_notices(spark):
    docs = spark.createDataFrame([(1, "Released under the MIT License.")] * 3, "doc_id long, text string")
    assert [(r.text_license, r.notices) for r in license_scan.scan(docs).collect()] == [("MIT", 1)] * 3


def test_no_python_and_no_unbounded_broadcast(spark):
    plan = license_scan.scan(odd_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    many = spark.range(10).select(F.col("id").cast("string").alias("license_id"), F.lit("x y").alias("text"))
    assert license_scan.scan(odd_docs(spark), many).count() == 15
