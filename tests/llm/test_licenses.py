"""Licences as they stand in files: in comment blocks, in full, and within lines."""

import textwrap

import pytest

from tidemark.llm import licenses


def found(spark, text):
    rows = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    return {(r.unit, r.license, r.template) for r in rows if r.best}


@pytest.mark.parametrize("mark", ["#", " *", "//", ";", "--", "%"])
def test_every_template_in_a_comment_block(spark, mark):
    blocks = []
    for texts in licenses.TEMPLATES.values():
        for text in texts:
            lines = textwrap.wrap(text, 70)
            blocks.append(f"code();\n{mark}\n" + "".join(f"{mark} {line}\n" for line in lines) + f"{mark}\n{mark} more\n")
    table = spark.createDataFrame(list(enumerate(blocks)), "doc_id long, text string")
    best = {(r.doc_id, r.license, r.template) for r in licenses.scan_licenses(table).collect() if r.dice == 1.0}
    names = [(name, k) for name, texts in licenses.TEMPLATES.items() for k in range(len(texts))]
    assert best >= {(i, name, k) for i, (name, k) in enumerate(names)}


def test_a_sentence_within_a_line(spark):
    line = "See the notes. Released under the MIT License. All else is (c) 2020; Licensed under CC BY 4.0."
    assert found(spark, "a\n" + line + "\nb") == {("sentence", "MIT", 0), ("sentence", "CC-BY-4.0", 0)}
    assert found(spark, "Released under the MIT License.") == {("line", "MIT", 0)}
    assert found(spark, "See the notes. Nothing of the kind is licensed here.") == set()


def test_variants_of_one_text_are_told_apart(spark):
    two, three = licenses.TEMPLATES["BSD-2-Clause"][1], licenses.TEMPLATES["BSD-3-Clause"][2]
    assert found(spark, two) == {("line", "BSD-2-Clause", 1)} | {u for u in found(spark, two) if u[0] == "sentence"}
    assert ("line", "BSD-3-Clause", 2) in found(spark, three)
    lesser, affero = licenses.TEMPLATES["LGPL-3.0"][1], licenses.TEMPLATES["AGPL-3.0"][1]
    assert ("line", "LGPL-3.0", 1) in found(spark, lesser) and ("line", "AGPL-3.0", 1) in found(spark, affero)
