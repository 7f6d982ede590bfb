"""Known licences keep their form at every width, with and without notices above."""

import textwrap

import pytest
from pyspark.sql import functions as F

from connlens.llm import licences

NOTICES = ["Copyright (c) 2020 Someone", "Copyright 1999-2004, A. Body", "Copyright Some Body Inc.", "(c) 2011 A", "© A", "All rights reserved."]


def test_known_licences_at_all_widths(spark):
    rows = []
    for name, text in licences.LICENCES:
        for width in (*range(40, 101, 3), 10_000):
            wrapped = "\n\n".join("\n".join(textwrap.wrap(p, width, break_long_words=False, break_on_hyphens=False)) for p in text.split("\n\n"))
            rows += [(len(rows), name, wrapped), (len(rows) + 1, name, "\n".join(NOTICES) + "\n\n" + wrapped)]
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")
    found = {r.doc_id: r.licence for r in licences.scanned(docs).collect()}
    assert [(i, n) for i, n, _ in rows if found[i] != n] == []


@pytest.mark.parametrize("line", ["copyright notice and this permission notice appear in all copies.", "COPYRIGHT HOLDERS AND CONTRIBUTORS", "(c) You must retain all notices"])
def test_lines_of_the_body_stay(spark, line):
    canonical = spark.createDataFrame([(line,)], "text string").select(licences.canonical(F.col("text"))).first()[0]
    assert canonical.split()[-1] == line.lower().rstrip(".").split()[-1]
