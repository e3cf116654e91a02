"""Whole results where an operator once stopped short."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, host_rules, html_render, pii, simhash

TABLES, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


# --- host rules


def test_strict_rules_act_at_usual_host_rates(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    judged = host_rules.judge_documents(docs)
    lost = judged.filter(~F.col("base_failed") & ~F.col("kept")).select("doc_id")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    quality = [r.quality for r in lost.join(labels, "doc_id", "left").collect()]
    assert len(quality) > 600 and 0 in quality and 1 not in quality


def test_limits_tighten_with_the_rate_of_all_rules(spark):
    clean = " ".join(f"clean{i} words{i}" for i in range(30))
    marks = {n: " ".join(f"word{i} " + "#" * n for i in range(30)) for n in (1, 2, 9)}
    rows = [(i, clean, h) for h, n in (("good", 900), ("mixed", 700), ("bad", 90)) for i in range(n)]
    rows += [(2000 + i, marks[9], h) for h, n in (("mixed", 200), ("bad", 810)) for i in range(n)]
    rows += [(n, marks[n], h) for h in ("good", "mixed", "bad") for n in marks]
    docs = spark.createDataFrame([(-i if t != clean else i, t, h) for i, t, h in rows], "doc_id int, text string, source string")
    for limit in (10, 0):
        kept = host_rules.judge_documents(docs, max_broadcast=limit).filter("kept and doc_id < 0").collect()
        assert {(r.source, -r.doc_id) for r in kept} == {("good", 1), ("good", 2)}


# --- near copies


def test_first_of_every_component(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    first = simhash.near_duplicates(docs).filter("doc_id = component_id").select("doc_id")
    assert {r.doc_id for r in simhash.keep_first(docs).select("doc_id").collect()} == {r.doc_id for r in first.collect()}
    kept = simhash.keep_first(docs.unionByName(docs))  # rows repeated in every column stay once
    assert kept.count() == first.count()


# --- decontamination


def test_partial_passages_at_every_offset():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(45)]
    item = " ".join(words)
    index = decontaminate.build_index([("i", item), ("j", "zz " * 30)])
    lead, tail = "klmno pqrs " * 9, " tuv wxyz" * 9
    for size in (64, 75):
        for at in range(len(item) - size):
            passage = item[at : at + size].strip()
            if len(passage) < 64:
                continue
            changed = passage[:20] + "Q" + passage[21:40] + passage[41:]
            for text in (passage, changed):
                found = decontaminate.leaks_of_texts([lead + text + tail, lead + tail], index)
                assert list(found) == [(0, 0)], (size, at)
    assert not decontaminate.leaks_of_texts([lead + item[5:50] + tail], index)


def test_short_items_are_whole_words(monkeypatch):
    items = [(1, "Go 7!"), (2, "a"), (3, "what is the capital of"), (4, "x" * 40)]
    index = decontaminate.build_index(items)
    texts = ["we go, 7 times", "go 77", "ergo 7", "A", "ab", None, "go", "7", "So: what is--the CAPITAL of France?", "whatis the capital of"]
    found = decontaminate.leaks_of_texts(texts, index)
    assert set(found) == {(0, 0), (3, 1), (8, 2)}
    assert found[0, 0][0][1:] == (0, 3, 8)
    monkeypatch.setattr(decontaminate, "SEGMENT", 500)
    for lead in range(470, 520):
        inside = decontaminate.leaks_of_texts(["b" * lead + "a" + "b" * 6000, "b" * lead + " a " + "b" * 6000], index)
        assert list(inside) == [(1, 1)]


# --- pages


def test_sheets_that_do_not_hold_hide_nothing():
    for sheet in (
        "<style>@media print { .x { display:none } }</style>",
        "<style>@media (max-width:600px) { .y{color:red} .x { display:none } }</style>",
        "<style media=print>.x{display:none}</style>",
        "<style>@media not screen{.x{display:none}} @keyframes k{from{display:none}} @page{display:none}</style>",
        "<style>.x{display:none} .x{display:block}</style>",
        "<style>#i{visibility:hidden}</style><style>#i{visibility:visible}</style>",
        "<style>.x{display:none}</style><style>p.x{display:block} .x{display:none}</style>",
        "<style>.x{display:none !important} .x{display:block!important}</style>",
        "<style>.x{content:'}';color:red;&:hover{display:none}}</style>",
        "<style>.x{display:block}</style><style>@supports not (display:grid){.x{display:none}}</style>",
    ):
        assert html_render.visible_text(sheet + "<p class=x id=i>seen") == "seen", sheet
    assert html_render.visible_text("<style>.x{display:none}</style><p class=x style='display:block'>seen") == "seen"
    assert html_render.visible_text("<p hidden style='display:block'>seen") == "seen"
    assert html_render.visible_text("<div style='visibility:hidden'>no<ul><li>no<li style='visibility:visible'>yes</ul></div>") == "- yes"


def test_sheets_that_hold_hide():
    for sheet in (
        "<style>@media screen and (min-width:600px) { .x { display:none } }</style>",
        "<style>@import 'a.css'; @media all{@supports (display:grid){p{display:none}}}</style>",
        "<style media='only screen'>.x{display:none}</style>",
        "<style>.x{display:none!important} #i{display:block}</style>",
        "<style>.x{display:block} /* {} */ .x{display:none}</style>",
        "<style>#i{visibility:hidden} .x{visibility:visible}</style>",
        "<style>.x{display:none",
    ):
        page = sheet + "</style><p class=x id=i>gone</p>and <b>more</b>"
        assert html_render.visible_text(page) == "and more", sheet
    assert html_render.visible_text("<style>.x{display:none!important}</style><p class=x style='display:block'>gone") == ""


# --- personal data


def test_values_behind_and_inside_others_are_found():
    there, back = pii.Pseudonymizer("k"), pii.Pseudonymizer("k", inverse=True)
    card = "4111 1111 1111 1111"
    for text, expected in (
        ("born 1985-04-12T09:30:00Z", ["date"]),
        ("at 1985-04-12T093000Z", ["date"]),
        (f"+44 20 7946 0958 {card}", ["card", "phone"]),
        (f"BE68 5390 0754 7034 {card}", ["card", "iban"]),
        (f"AB12 {card}", ["card"]),
        (f"9999 {card}", ["card"]),
    ):
        new, kinds = there.text(text)
        assert sorted(kinds) == expected and back.text(new)[0] == text, text
        assert card not in new and "1985-04-12" not in new
    for text in ("1985-04-12x", "1985-04-12Test", "1985-04-123", "10.0.0.1.2024-01-01"):
        assert there.text(text) == (text, [])


def test_dates_are_linked_in_every_spelling():
    there, back = pii.Pseudonymizer("k"), pii.Pseudonymizer("k", inverse=True)
    images = set()
    for day in ("2020-04-13", "1999-12-31", "2020-04-05"):
        y, m, d = day.split("-")
        spelled = [day, f"{y}/{m}/{d}", f"{d}.{m}.{y}", f"{m}/{d}/{y}"] + [f"{d}/{m}/{y}"] * (int(d) > 12)
        new, kinds = there.text(" ".join(spelled))
        assert len(kinds) == len(spelled) and back.text(new)[0] == " ".join(spelled)
        y, m, d = new.split()[0].split("-")
        want = [f"{y}-{m}-{d}", f"{y}/{m}/{d}", f"{d}.{m}.{y}", f"{m}/{d}/{y}"] + [f"{d}/{m}/{y}"] * (len(spelled) > 4)
        assert new.split() == want
        images.add(new.split()[0])
    assert len(images) == 3


ITEM = "this is a benchmark item of some sixty two characters in total"


@pytest.mark.parametrize("gap", [0, 4_500, 30_000])
def test_gaps_across_cuts_lose_nothing(monkeypatch, gap):
    monkeypatch.setattr(decontaminate, "SEGMENT", 8192)
    index = decontaminate.build_index([(1, ITEM)])
    for offset in range(0, 800, 160):
        for place in (10, 30, 50):
            at = ITEM.index(" ", place)
            filler = "filler words go on " * ((8192 * 2 - 500 + offset) // 19)
            text = filler + ITEM[:at] + " " * gap + ITEM[at:] + " end of it all" * 900
            leaks = decontaminate.leaks_of_texts([None, text], index)
            assert list(leaks) == [(1, 0)]
            _, edits, start, end = leaks[1, 0][0]
            assert edits == 0 and text[start:end].split() == ITEM.split()


def test_repetitive_texts_stay_small(monkeypatch):
    """Where every place of a text meets every place of an item, parts are looked at."""
    index = decontaminate.build_index([(1, "ab " * 60), (2, ITEM)])
    plain = decontaminate.leaks_of_texts(["x " + "ab " * 900 + ITEM], index)
    monkeypatch.setattr(decontaminate, "MAX_SHARED", 1000)
    parts = decontaminate.leaks_of_texts(["x " + "ab " * 900 + ITEM], index)
    assert plain == parts and {len(v) for v in plain.values()} == {116, 1}
    assert all(edits == 0 for rows in plain.values() for _, edits, *_ in rows)


def test_missing_grams_need_edits():
    """The windows given up before alignment are none that alignment would accept."""
    rng = random.Random(4)
    letters = "abcde "
    item = "".join(rng.choice(letters) for _ in range(90))
    index = decontaminate.build_index([(1, item)])
    for _ in range(60):
        text = list(item)
        for _ in range(rng.randrange(12)):
            at = rng.randrange(len(text))
            text[at : at + rng.randrange(2)] = rng.choice(["", rng.choice(letters)])
        text = "zz " + "".join(text) + " yy"
        chars, _ = decontaminate.normalize(text)
        found = {w for w, *_ in decontaminate.find_leaks(chars, index)}
        low = decontaminate.np.arange(-8, len(chars))
        for window in range(int(index.of_windows[0])):
            rows = decontaminate.np.repeat(index.chars[window : window + 1], len(low), axis=0)
            sizes = decontaminate.np.full(len(low), int(index.size[0]))
            edits, _ = decontaminate.align(chars, rows, sizes, low, decontaminate.np.full(len(low), 8))
            assert (edits.min() <= index.budget[0]) == (window in found)
