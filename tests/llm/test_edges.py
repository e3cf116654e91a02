"""Nulls, empty and very long texts, repeats, ties, empty tables and clashing columns."""



import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (
    decontaminate,
    host_rules,
    html_render,
    licenses,
    pieces,
    pii,
    sharding,
    simhash,
    suffix_dedup,
    toxicity,
)
from tidemark.llm.queries import PIECE_MODEL

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, fp string, "
    "kept string, key string, h1 string, slot string, host string, `end` string, found string, "
    "mark string, units string, label double, extra map<string,string>"
)
LONG = " ".join(f"word{i % 977} says{i % 89}" for i in range(40_000))
PLAIN = " ".join(f"plain{i} text{i * 7}" for i in range(30))
TEXTS = [None, "", " \t\n", "one two", PLAIN, PLAIN, LONG, LONG + "\nend", "x" * 300_000]


def table(spark, rows):
    fill = ["c"] * 11
    data = [
        (i, t, "en", s, 1, *fill, 1.0 if t and "two" in t else 0.0, {"a": "b"}) for i, t, s in rows
    ]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)]
    rows += [(4, PLAIN, "s"), (4, PLAIN, "s"), (None, PLAIN, None), (None, None, None), (77, PLAIN, None)]
    return table(spark, rows).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def benchmark(spark):
    text = " ".join(PLAIN.split()[10:30])
    return spark.createDataFrame([(1, text), (2, None), (None, ""), (3, "short")], "item_id bigint, text string")


N = len(TEXTS) + 5


def test_sharding(edges, nothing):
    out = sharding.shard_records(edges, "doc_id", [1.0, 2.0], [1.0, 2.0, 1.0])
    numbered = sharding.number_slots(out, ["doc_id", "text"]).collect()
    assert len(numbered) == N
    by_id = {}
    for row in numbered:
        assert by_id.setdefault(row.doc_id, row.shard) == row.shard
        assert row.grown_shard in (row.shard, 2)
    for shard in {r.shard for r in numbered}:
        slots = sorted(r.slot for r in numbered if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert sharding.number_slots(sharding.shard_records(nothing, "doc_id", [1.0]), ["doc_id"]).count() == 0


def test_licenses(edges, nothing, spark):
    assert licenses.scan_licenses(edges).count() == 0
    assert licenses.scan_licenses(nothing).count() == 0
    mit = table(spark, [(1, "a\nReleased under the MIT License.", "s")] * 2 + [(None, "released UNDER the mit license", "s")])
    rows = licenses.scan_licenses(mit).collect()
    assert sorted((r.doc_id or 0, r.unit, r.position, r.license, r.best) for r in rows) == [
        (0, "line", 0, "MIT", True),
        *[(1, "line", 1, "MIT", True)] * 2,
        *[(1, "paragraph", 0, "MIT", True)] * 2,
    ]


def test_html(spark):
    pages = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "<div>" * 30_000 + "deep", "x"), (4, "<script>a</script>", "x"), (5, "<p>a", "x"), (5, "<p>a", "x")],
        "page_id bigint, html string, text string",
    )
    out = sorted((r.page_id, r.text) for r in html_render.extract_text(pages).collect())
    assert out == [(1, None), (2, ""), (3, "deep"), (4, ""), (5, "a"), (5, "a")]
    assert html_render.extract_text(pages.limit(0)).count() == 0


def test_pii(edges, nothing):
    with pytest.raises(ValueError, match="key"):
        pii.pseudonymize(edges)
    out = pii.pseudonymize(edges, key="k")
    assert sorted(map(repr, (r.text for r in out.collect()))) == sorted(map(repr, (r.text for r in edges.collect())))
    assert {r.n_values for r in out.collect()} == {0}
    assert pii.pseudonymize(nothing, key="k").count() == 0


def test_simhash(edges, nothing):
    rows = simhash.near_duplicates(edges).collect()
    assert len(rows) == N
    blank = {r.component_id for r in rows if r.fingerprint == "0" * 16}
    assert blank == {0}
    plain = [r for r in rows if r.doc_id in (4, 5, 77)]
    assert {r.component_id for r in plain} == {4} and len(plain) == 5
    assert simhash.near_duplicates(nothing).count() == 0
    only_null = edges.filter("doc_id is null and text is not null")
    assert [r.component_id for r in simhash.near_duplicates(only_null).collect()] == [None]


def test_keep_first(edges, nothing):
    out = simhash.keep_first(edges)
    assert out.columns == edges.columns
    assert sorted(r.doc_id for r in out.collect()) == [0, 3, 4, 6, 8]
    assert simhash.keep_first(nothing).count() == 0


def test_hosts(edges, nothing):
    judged = host_rules.judge_documents(edges).collect()
    assert len(judged) == N
    short = [r for r in judged if r.text is None or len(r.text.split()) < 20]
    assert all(r.base_failed and not r.kept for r in short)
    assert all(r.kept for r in judged if r.text == PLAIN)
    assert host_rules.judge_documents(nothing).count() == 0
    kept = host_rules.keep_good(edges)
    assert kept.columns == edges.columns and kept.count() == sum(r.kept for r in judged)
    shuffled = host_rules.judge_documents(edges, max_broadcast=0, suspect_rate=0.0).count()
    assert shuffled == N


def test_decontamination(edges, nothing, benchmark):
    rows = decontaminate.contaminated_items(edges, benchmark).collect()
    assert sorted((r.doc_id or -1, r.item_id) for r in rows) == [(-1, 1), (4, 1), (4, 1), (4, 1), (5, 1), (77, 1)]
    clean = decontaminate.drop_contaminated(edges, benchmark)
    assert clean.columns == edges.columns and clean.count() == N - 6
    assert decontaminate.contaminated_items(nothing, benchmark).count() == 0
    none = benchmark.limit(0)
    assert decontaminate.contaminated_items(edges, none).count() == 0
    assert decontaminate.drop_contaminated(edges, none).count() == N
    blocks = decontaminate.contaminated_items(edges, benchmark.union(benchmark), block_chars=10)
    assert blocks.count() == 12


def test_pieces(edges, nothing):
    model = pieces.read_model(PIECE_MODEL)
    rows = pieces.encode_documents(edges, model, giant=20_000, chunk=5_000).collect()
    assert len(rows) == N and all(r.round_trip for r in rows)
    assert sorted(len(r.ids) for r in rows if r.doc_id in (0, 1)) == [0, 0]
    assert pieces.encode_documents(nothing, model).count() == 0


def test_suffixes(edges, nothing):
    rows = suffix_dedup.remove_repeats(edges).collect()
    assert len(rows) == N
    size = len(PLAIN)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans))
    assert by_id[4] == [(size, 0, 0)] * 3 and by_id[5] == by_id[77] == [(size, size, 1)]
    assert sorted(by_id[None]) == [(0, 0, 0), (size, size, 1)]
    assert by_id[0] == [(0, 0, 0)] and by_id[8] == [(300_000, 0, 0)]
    assert by_id[7] == [(len(LONG) + 4, len(LONG), 1)]
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_toxicity(edges, nothing):
    weights = toxicity.train(edges)
    scores = {r.doc_id: r.s for r in edges.select("doc_id", toxicity.score(F.col("text"), weights, edges).alias("s")).collect()}
    assert len(scores) == 11 and all(0 <= s <= 1 for s in scores.values())
    assert scores[0] == scores[1] == scores[2]
    empty = toxicity.train(nothing)
    assert edges.select(toxicity.score(F.col("text"), empty, edges).alias("s")).first().s == 0.5


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage(spark, edges, nothing, benchmark, tmp_path, name, stage):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (edges, nothing):
        out = stage(spark, docs, str(tmp_path))
        assert out.count() <= docs.count()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns


