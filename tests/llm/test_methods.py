"""The operators against brute force, exact round trips and held-out rows."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from oracle_check import duck, duck_result, spark_result
from tidemark.llm import (
    decontaminate,
    graph,
    host_rules,
    html_render,
    licenses,
    pieces,
    pii,
    queries,
    sharding,
    simhash,
    suffix_dedup,
    toxicity,
)
from tidemark.llm.oracle import ORACLE

TABLES, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    assert spark_result(queries.QUERIES[name](spark, TABLES)) == duck_result(duck(TABLES), ORACLE[name])


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())


# --- sharding


def test_a_new_shard_takes_rows_only_into_itself(spark):
    df = spark.range(20_000)
    weights = [1.0, 2.0, 1.0, 4.0]
    out = sharding.shard_records(df, "id", weights, [*weights, 2.0]).collect()
    assert all(r.grown_shard in (r.shard, 4) for r in out)
    shares = np.bincount([r.shard for r in out]) / len(out)
    assert np.allclose(shares, np.array(weights) / 8, atol=0.02)
    assert abs(sum(r.grown_shard == 4 for r in out) / len(out) - 0.2) < 0.02
    direct = sharding.shard_records(df, "id", [*weights, 2.0]).collect()
    assert {r.id: r.shard for r in direct} == {r.id: r.grown_shard for r in out}


# --- licences


def test_size_bounds_and_witnesses_lose_nothing():
    words = "a b c d e f g h".split()
    rng = random.Random(2)
    for _ in range(300):
        template = [rng.choice(words) for _ in range(rng.randint(2, 9))]
        text = [rng.choice(words) for _ in range(rng.randint(2, 9))]
        a = {f"{x} {y}" for x, y in zip(template, template[1:])}
        b = {f"{x} {y}" for x, y in zip(text, text[1:])}
        if 2 * len(a & b) / (len(a) + len(b)) >= 0.8:
            low, high = licenses._bounds(len(a), 0.8)
            assert low <= len(b) <= high
            assert licenses.witness_words(sorted(a), 0.8, set()) & set(text)


# --- personal data


def test_permutations_are_one_to_one_and_invertible():
    p = pii.Permuter("key")
    for size in (1, 2, 3, 10, 97, 1000):
        image = [p.permute("x", size, i) for i in range(size)]
        assert sorted(image) == list(range(size))
        assert [p.permute("x", size, v, inverse=True) for v in image] == list(range(size))
    assert p.permute("x", 10**30, 5) != pii.Permuter("other").permute("x", 10**30, 5)


def test_pseudonyms_keep_formats_and_link_equal_values():
    there, back = pii.Pseudonymizer("k"), pii.Pseudonymizer("k", inverse=True)
    text = (
        "a.b7@x.example.com 4845168114407329 4845-1681-1440-7329 192.168.1.20 +1 (017) 555-7713 "
        "017-555-7713 2001-02-28 28.02.2001 31/12/1999 123-45-6789 DE89370400440532013000 "
        'token = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b"'
    )
    new, kinds = there.text(text)
    assert len(kinds) == 12 and back.text(new)[0] == text
    old, fresh = text.split(), new.split()
    assert [re.sub(r"[0-9]", "9", re.sub(r"[a-z]", "a", t)) for t in old[:3]] == [
        re.sub(r"[0-9]", "9", re.sub(r"[a-z]", "a", t)) for t in fresh[:3]
    ]
    card = fresh[1]
    assert pii.luhn_digit(card[:-1]) == card[-1] and fresh[2].replace("-", "") == card
    assert fresh[9].split(".")[::-1] == fresh[8].split("-")
    crowd = "+1 (017) 555-7713 555 DE89 3704 0044 0532 0130 00 ABCD EF 4845168114407329 12 4845 1681 1440 7329 7"
    hidden, kinds = there.text(crowd)
    assert sorted(kinds) == ["card", "card", "iban", "phone"] and back.text(hidden)[0] == crowd
    untouched = "+99999999999999999999999 9807915762804490 2001-02-29 300.1.1.1 000-12-3456 version 3.0, call 12345"
    assert there.text(untouched) == (untouched, [])


# --- pieces


@pytest.fixture(scope="module")
def model():
    return pieces.Model(pieces.read_model(queries.PIECE_MODEL))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)


def noise(rng, n):
    return "".join(rng.choice(["ing", "the ", "  ", "\n", "é", "漢", "😀", "▁", "x", "<0x41>", "\t"]) for _ in range(n))


def test_ids_are_the_models_own(model, library, texts):
    rng = random.Random(4)
    for text in [*texts.values(), *(noise(rng, rng.randint(0, 30)) for _ in range(500))]:
        ids = model.encode(text).tolist()
        assert ids == library.encode(text)
        assert model.decode(ids) == text.replace("▁", " ")


@pytest.mark.parametrize("size", [1, 5, 16, 40])
def test_any_chunks_give_the_same_ids(model, library, size):
    rng = random.Random(size)
    for _ in range(60):
        text = noise(rng, 40) if rng.random() < 0.5 else "".join(rng.choice("etaoin") for _ in range(90))
        marked = pieces.marked(text)
        cuts, side, chunks = [*range(0, len(marked), size), len(marked)], model.longest, []
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            low, high = max(a - side, 0), min(b + side, len(marked))
            chunks.append(pieces.Chunk(model, marked[low:high], a - low, b - low, k == 0, k == len(cuts) - 2))
        matrices = [c.matrix() for c in chunks]
        path = pieces.cut_states(matrices, 0, 0)
        ids = np.concatenate([c.ids(i, j) for c, i, j in zip(chunks, path, path[1:])]).tolist()
        assert ids == library.encode(text)


def test_matrices_combine_in_any_grouping():
    rng = np.random.default_rng(1)
    a, b, c = (np.where(rng.random((3, 3)) < 0.5, 0.0, -np.inf) for _ in range(3))
    left, right = pieces.max_plus(pieces.max_plus(a, b), c), pieces.max_plus(a, pieces.max_plus(b, c))
    assert np.array_equal(left, right)


def test_giant_documents_across_tasks(spark, library, texts):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    proto = pieces.read_model(queries.PIECE_MODEL)
    rows = pieces.encode_documents(docs, proto, giant=1_000, chunk=61).collect()
    assert len(rows) == len(texts) and all(r.round_trip for r in rows)
    assert all(r.ids == library.encode(texts[r.doc_id]) for r in rows)
    encoded = spark.createDataFrame([(r.doc_id, r.ids) for r in rows[:20]], "doc_id long, ids array<int>")
    for r in encoded.select("doc_id", pieces.decoded(F.col("ids"), proto, spark).alias("t")).collect():
        assert r.t == texts[r.doc_id]


# --- suffixes


def brute_repeats(docs, length):
    first, out = {}, {}
    for i, data in sorted(docs.items()):
        gone = bytearray(len(data))
        for s in range(len(data) - length + 1):
            if first.get(data[s : s + length], i) < i:
                gone[s : s + length] = b"\1" * length
        for s in range(len(data) - length + 1):
            first.setdefault(data[s : s + length], i)
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_on_the_table(spark, texts):
    rows = queries.op5_suffix_dedup(spark, SMALL).collect()
    expected = brute_repeats({i: t.encode() for i, t in texts.items()}, 50)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == expected


def test_repeats_in_blocks_and_long_texts(spark, monkeypatch):
    rng = random.Random(9)
    parts = ["".join(rng.choice("ab") for _ in range(n)) for n in (60, 49, 50, 51, 130)]
    docs = {i: "".join(rng.choice([*parts, "é", "zz"]) for _ in range(rng.randint(0, 9))) for i in range(60)}
    table = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 200)  # the tasks run in processes of their own
    expected = brute_repeats({i: t.encode() for i, t in docs.items()}, 50)
    for group_bytes in (1 << 20, 400):
        rows = suffix_dedup.remove_repeats(table, group_bytes=group_bytes).collect()
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in rows}
        assert got == expected
    pieces_ = list(suffix_dedup._blocks(iter([_batch(docs)]), 50))
    assert max(len(p[3]) for block in pieces_ for p in block) <= 249


def _batch(docs):
    import pyarrow as pa

    columns = [pa.array(list(docs)), pa.array([0] * len(docs)), pa.array(list(docs.values()))]
    return pa.record_batch(columns, ["doc_id", "mark", "text"])


@pytest.mark.parametrize("shallow", [1, 3, 7])
def test_equal_suffixes(shallow):
    rng = np.random.default_rng(shallow)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    data[200:] = data[:200]
    at = np.arange(len(data) - 50)
    owner = (at >= 180).astype(np.int64)
    members, group = suffix_dedup.equal_suffixes(data, at, owner, 50, shallow)
    found = {}
    for m, g in zip(members.tolist(), group.tolist()):
        found.setdefault(g, set()).add(m)
    strings = {}
    for p in at.tolist():
        strings.setdefault(data[p : p + 50].tobytes(), set()).add(p)
    expected = [s for s in strings.values() if len({int(owner[p]) for p in s}) > 1]
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected))


# --- pages


def test_page_layout():
    page = (
        "<title>T</title><p>One<p>Two &amp; <b>three<br>four</b><div hidden>no</div>"
        "<style>.ad{display:none}</style><div class='ad x'>ad</div>"
        "<ul><li>a<li>b<ol start=3><li>x<li>y</ol></ul>"
        "<table><tr><th>Name<th>Qty<tr><td>Apple<td>3<tr><td colspan=2>both<tr><td>B<td>10000</table>"
        "<pre>\n a\n  b</pre><script>if(a<b)'</p>'</script>"
    )
    assert html_render.visible_text(page) == (
        "One\n\nTwo & three\nfour\n\n- a\n- b\n  3. x\n  4. y\n\n"
        "Name  | Qty\nApple | 3\nboth\nB     | 10000\n\n a\n  b"
    )


# --- SimHash


@pytest.mark.parametrize("masks", [simhash.covering_masks(), simhash.fine_masks()])
def test_masks_cover_every_pair_within_the_radius(masks):
    for bits in itertools.combinations(range(64), 3):
        differing = sum(1 << b for b in bits)
        assert any(not differing & m for m in masks)


def test_fingerprints_by_definition(spark, texts):
    got = {r.doc_id: r.fingerprint for r in simhash.near_duplicates(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()}
    for i, text in texts.items():
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        shingles = [" ".join(words[k : k + 3]) for k in range(max(len(words) - 2, 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert got[i] == f"{value:016x}"


@pytest.mark.parametrize("max_bucket", [4096, 3])
def test_components_equal_brute_force(spark, max_bucket):
    rng = random.Random(6)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    values = {0, *seeds}
    for seed in seeds:
        for _ in range(25):
            seed ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            values.add(seed)
    values = sorted(values)
    rows = [(i, simhash._signed(v)) for i, v in enumerate(values)]
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(values)), 2):
        if (values[a] ^ values[b]).bit_count() <= 3:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    got = simhash.component_of_rows(spark.createDataFrame(rows, "doc_id long, fp long"), 3, max_bucket)
    assert {r.doc_id: r.component_id for r in got.collect()} == {i: find(i) for i in range(len(values))}


def test_components_of_a_long_chain(spark):
    links = spark.range(500).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in graph.components(links).collect()} == {0}


# --- host rules


def test_repeated_words_by_definition():
    rng = random.Random(3)
    for _ in range(300):
        words = [rng.choice("ab").encode() for _ in range(rng.randint(0, 40))]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
        assert host_rules.repeated_words(words) == len(inside)


def test_suspect_hosts_keep_clean_documents(spark):
    clean = " ".join(f"clean{i} words{i}" for i in range(30))
    marks = " ".join(f"word{i} ###" for i in range(30))
    rows = [(i, "short", "bad") for i in range(300)] + [(i, clean, "good") for i in range(1000, 1900)]
    rows += [(500, clean, "bad"), (501, marks, "bad"), (502, marks, "good"), (503, clean, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for limit in (10, 0):  # by broadcast and by shuffle
        kept = {r.doc_id for r in host_rules.judge_documents(table, max_broadcast=limit).filter("kept").collect()}
        assert kept == {*range(1000, 1900), 500, 502, 503}


def test_prior_is_strong_where_hosts_agree():
    a, b = host_rules.beta_prior(10, 1000, 100, 1000 * 0.01, 10 * 100.0**2)
    assert a / (a + b) == pytest.approx(0.1) and a + b == 1e6
    a, b = host_rules.beta_prior(2, 200, 100, 100.0, 2 * 100.0**2)
    assert a + b == pytest.approx(1.0, abs=0.1)


# --- decontamination


def edit_distance_within(pattern, text):
    """The fewest edits of the pattern against any substring of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_windows_equal_brute_force():
    rng = random.Random(8)
    letters = "abcdefgh "
    item = "".join(rng.choice(letters) for _ in range(64)).replace("  ", "a ")
    index = decontaminate.build_index([(1, item)])
    for edits in range(0, 14):
        passage = list(item)
        for _ in range(edits):
            at = rng.randrange(len(passage))
            kind = rng.randrange(3)
            passage[at : at + (kind != 1)] = [] if kind == 2 else [rng.choice("xyz")]
        text = "".join(rng.choice("klmno ") for _ in range(50)) + " " + "".join(passage) + " " + "".join(rng.choice("klmno ") for _ in range(50))
        chars, _ = decontaminate.normalize(text)
        window = index.chars[0, : index.size[0]]
        close = edit_distance_within(window.tolist(), chars.tolist()) <= index.budget[0]
        assert bool(decontaminate.leaks_of_texts([text], index)) == close


def test_planted_passages_are_found_and_clean_texts_left_alone(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{TABLES}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{TABLES}/benchmark.parquet'").fetchall()
    whole = {(d, i) for d, text in docs for i, item in items if item in text}
    got = {(r.doc_id, r.item_id) for r in queries.op10_decontaminate(spark, TABLES).collect()}
    assert whole <= got and len(got - whole) <= 1


def test_long_texts_are_searched_in_segments(monkeypatch):
    monkeypatch.setattr(decontaminate, "SEGMENT", 500)
    item = " ".join(f"passage{i}" for i in range(20))
    index = decontaminate.build_index([(1, item)])
    for lead in range(0, 6_000, 397):
        text = "filler " * (lead // 7) + item + " filler" * 700
        found = decontaminate.leaks_of_texts([text], index)
        (spans,) = found.values()
        assert text[spans[0][2] : spans[-1][3]].strip() == item


# --- toxicity


def test_held_out_rows(spark):
    data = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{data}/labels.parquet")
    rows = queries.op1_toxicity(spark, data).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(r.held_out for r in held) and len(held) == sum(r.held_out for r in rows)
    toxic = [r.predicted for r in held if r.toxic]
    clean = [r.predicted for r in held if not r.toxic]
    assert np.mean(toxic) > 0.7 and np.mean(clean) < 0.01


def test_word_pairs_and_long_texts(monkeypatch):
    assert len(toxicity.features("a b c")) == 3 + 2 + 1
    assert len(toxicity.features("a a a a a")) == 1 + 3
    assert np.array_equal(toxicity.word_hashes("One, TWO"), toxicity.word_hashes("one two"))
    text = " ".join(f"w{i}" for i in range(3_000))
    whole = toxicity.features(text)
    monkeypatch.setattr(toxicity, "_PIECE", 500)
    assert np.array_equal(toxicity.features(text), whole)


# --- pipeline


def test_pipeline_equals_its_stages_one_by_one(spark, texts, library):
    rows = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SMALL).collect()}
    index = decontaminate.build_index(
        duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()
    )
    judged = host_rules.judge_documents(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    good = sorted(r.doc_id for r in judged if r.kept)
    prints = {i: simhash.fingerprints(texts[i], 3)[0] for i in good}
    root = {i: i for i in good}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(good, 2):
        if ((prints[a] ^ prints[b]) & (1 << 64) - 1).bit_count() <= 3:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    first = [i for i in good if find(i) == i]
    clean = [i for i in first if not decontaminate.leaks_of_texts([texts[i]], index)]
    names = pii.Pseudonymizer(queries.SAMPLE_KEY)
    assert rows == {i: library.encode(names.text(texts[i])[0]) for i in clean}
