"""Approximate nearest neighbours by inner product with an adaptive dimension scan.

Vectors lie in lists around centroids. Within a list they are stored rotated, as blocks
of columns. A scan adds up a distance block by block; after each block a hypothesis test
on the partial distance gives up the candidates that will hardly reach the query's
threshold. The few that are left are scored exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import plain_columns, stored

NEIGHBOURS = 20
# Vectors the lists are fitted on, and the bytes they may take; a hash of the vector
# picks them.
SAMPLE_ROWS = 32_768
SAMPLE_BYTES = 16 << 20
MAX_LISTS = 1024
ROUNDS = 8
# Share of the expected neighbours that the lists left out may hold, and the fewest lists.
MISSED = 0.01
LEAST_LISTS = 4
# Lists are scanned in parts of about so many vectors.
PART_ROWS = 8192
# Columns in a block; the test after d columns is passed by (1 + CONFIDENCE / sqrt(d)).
BLOCK = 16
CONFIDENCE = 2.1
_SLICE = 1024
_AT_ONCE = 512
# Pairs are followed one by one once fewer than one in so many are left.
_FEW = 16
_BUCKETS = 1 << 20


@dataclass
class Index:
    """Rotation and rotated centroids, and per list the rows and the mean squared radius."""

    rotation: np.ndarray
    centroids: np.ndarray
    counts: np.ndarray = field(default_factory=lambda: np.empty(0))
    spread: np.ndarray = field(default_factory=lambda: np.empty(0))

    def nearest_list(self, rotated: np.ndarray) -> np.ndarray:
        half = 0.5 * np.einsum("ij,ij->i", self.centroids, self.centroids)
        return np.argmax(rotated @ self.centroids.T - half, axis=1)

    def parts(self) -> np.ndarray:
        return np.maximum(1, -(-self.counts // PART_ROWS)).astype(np.int64)


def fit(sample: np.ndarray, n_lists: int, rounds: int = ROUNDS, seed: int = 13) -> Index:
    """A random rotation and ``n_lists`` centroids of the rotated sample."""
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.standard_normal((sample.shape[1],) * 2))[0]
    rotated = sample @ rotation
    index = Index(rotation, rotated[rng.permutation(len(sample))[:n_lists]].copy())
    for _ in range(rounds):
        at = index.nearest_list(rotated)
        order = np.argsort(at, kind="stable")
        filled, starts = np.unique(at[order], return_index=True)
        sums = np.add.reduceat(rotated[order], starts, axis=0)
        index.centroids[filled] = sums / np.diff([*starts, len(at)])[:, None]
    return index


def _beyond(z: np.ndarray) -> np.ndarray:
    """The share of a normal distribution above ``z`` (a logistic fit, good to 2e-4)."""
    return 1 / (1 + np.exp(np.clip(1.5976 * z + 0.07056 * z**3, -700, 700)))


def choose_lists(index: Index, rotated: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The lists each query scans first, and those it scans then, as boolean matrices.

    Products with a list's members are taken to spread around the centroid's by the
    list's radius, alike in all directions. The threshold at which all lists together
    are expected to hold ``k`` vectors gives each list its share of them; lists are taken
    from the largest share on until the rest holds ``MISSED`` of it, and are at least
    ``LEAST_LISTS``. The first of them, up to ``4 k`` rows, set the query's threshold.
    """
    centre = rotated @ index.centroids.T
    length = np.sqrt(np.einsum("ij,ij->i", rotated, rotated))[:, None]
    spread = np.maximum(length * np.sqrt(index.spread / rotated.shape[1])[None, :], 1e-12)
    low, high = (centre - 9 * spread).min(axis=1), (centre + 9 * spread).max(axis=1)
    for _ in range(40):
        middle = (low + high) / 2
        hits = (index.counts * _beyond((middle[:, None] - centre) / spread)).sum(axis=1)
        low, high = np.where(hits > k, middle, low), np.where(hits > k, high, middle)
    hits = index.counts * _beyond((low[:, None] - centre) / spread)
    order = np.lexsort((-centre, -hits), axis=1)
    rows = np.arange(len(rotated))[:, None]
    sorted_hits, sizes = hits[rows, order], index.counts[order]
    before = np.cumsum(sorted_hits, axis=1) - sorted_hits
    starting = np.cumsum(sizes, axis=1) - sizes < 4 * k
    wanted = before < (1 - MISSED) * sorted_hits.sum(axis=1, keepdims=True)
    wanted[:, :LEAST_LISTS] = True
    first, then = np.zeros_like(wanted), np.zeros_like(wanted)
    first[rows, order] = starting & (sizes > 0)
    then[rows, order] = wanted & ~starting & (sizes > 0)
    return first, then


def ordered_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of matching columns, added up from the first dimension on."""
    total = np.zeros(left.shape[1])
    for a, b in zip(left, right):
        total += a * b
    return total


class ListPart:
    """The vectors of a part of a list, as rotated column blocks."""

    def __init__(self, vectors: np.ndarray, firsts: np.ndarray, rotation: np.ndarray):
        self.columns = np.ascontiguousarray(vectors.T)
        self.firsts = firsts
        rotated = vectors @ rotation
        edges = range(0, rotated.shape[1], BLOCK)
        self.blocks = [np.ascontiguousarray(rotated[:, at : at + BLOCK]) for at in edges]
        self.squares = np.cumsum([np.einsum("ij,ij->i", b, b) for b in self.blocks], axis=0)

    def search(self, queries: np.ndarray, rotation: np.ndarray, tau: np.ndarray, k: int):
        """``query, member, score`` of the ``k`` best members of each query that pass its
        threshold ``tau`` and the tests; ties go to the smaller first id."""
        rotated, columns = queries @ rotation, np.ascontiguousarray(queries.T)
        width = rotated.shape[1]
        blocks = [rotated[:, at : at + BLOCK] for at in range(0, width, BLOCK)]
        squares = np.cumsum([np.einsum("ij,ij->i", b, b) for b in blocks], axis=0)
        tau = tau - 1e-9 * (1 + np.abs(tau))
        best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        for start in range(0, len(self.firsts), _SLICE):
            rows = slice(start, start + _SLICE)
            product, alive, pairs, seen = 0, True, None, 0
            for b, block in enumerate(blocks):
                # the partial distance is at most the slack share of the limit exactly
                # when the partial product is at least a query's and a member's number
                seen += block.shape[1]
                slack = (1 + CONFIDENCE / math.sqrt(seen)) ** 2 * seen / width if seen < width else 1 + 1e-9
                of_query = 0.5 * (squares[b] - slack * (squares[-1] - 2 * tau)) - 1e-12
                of_member = 0.5 * (self.squares[b][rows] - slack * self.squares[-1][rows])
                if pairs is None:  # many are left: whole blocks at once
                    product = product + block @ self.blocks[b][rows].T
                    alive = alive & (product >= np.add.outer(of_query, of_member))
                    if _FEW * np.count_nonzero(alive) < alive.size:
                        pairs = np.nonzero(alive)
                        product = product[pairs]
                else:  # few are left: only their rows
                    q, x = pairs
                    product = product + np.einsum("ij,ij->i", block[q], self.blocks[b][rows][x])
                    left = product >= of_query[q] + of_member[x]
                    pairs, product = (q[left], x[left]), product[left]
            q, x = np.nonzero(alive) if pairs is None else pairs
            x = x + start
            score = ordered_products(columns[:, q], self.columns[:, x])
            best = tuple(np.concatenate(pair) for pair in zip(best, (q, x, score)))
            order = np.lexsort((self.firsts[best[1]], -best[2], best[0]))
            best = tuple(column[order] for column in best)
            firsts = np.flatnonzero(np.diff(best[0], prepend=-1))
            place = np.arange(len(order)) - np.repeat(firsts, np.diff([*firsts, len(order)]))
            last = place == k - 1
            tau[best[0][last]] = np.maximum(tau[best[0][last]], best[2][last] - 1e-9 * (1 + np.abs(best[2][last])))
            best = tuple(column[place < k] for column in best)
        return best


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _assigned(index):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rotated = _matrix(batch.column("vec")) @ index.value.rotation
            at = index.value.nearest_list(rotated)
            radius = ((rotated - index.value.centroids[at]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int32)), pa.array(radius), *batch.columns],
                ["list", "radius", *batch.schema.names],
            )

    return assign


def _probes(index, k: int, turn: int):
    """A row for every query and part of a list that it scans first (0) or then (1)."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, parts = index.value, index.value.parts()
        for whole in batches:
            for at in range(0, whole.num_rows, _AT_ONCE):
                batch = whole.slice(at, _AT_ONCE)
                rotated = _matrix(batch.column("vec")) @ found.rotation
                query, lists = np.nonzero(choose_lists(found, rotated, k)[turn])
                copies = parts[lists]
                starts = np.repeat(np.cumsum(copies) - copies, copies)
                query, lists = np.repeat(query, copies), np.repeat(lists, copies)
                part = np.arange(len(lists)) - starts
                rows = batch.take(pa.array(query))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists.astype(np.int32)), pa.array(part.astype(np.int32)), *rows.columns],
                    ["list", "part", *rows.schema.names],
                )

    return probe


def _scanned(index, k: int):
    names = ["h1", "h2", "score", "ids"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotation = index.value.rotation
        group, held, part = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("list", "part", "kind")])
            cuts = np.flatnonzero(np.diff(keys, axis=1).any(axis=0)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                rows = batch.slice(start, end - start)
                here, kind = (keys[0][start], keys[1][start]), keys[2][start]
                if here != group:
                    group, held, part = here, [], None
                if kind == 0:
                    held.append(rows.select(["ids", "vec"]))
                    continue
                if part is None and held:
                    members = pa.Table.from_batches(held).combine_chunks()
                    ids = members["ids"].combine_chunks()
                    firsts = ids.values.to_numpy()[ids.offsets.to_numpy()[:-1]]
                    part = ListPart(_matrix(members["vec"].combine_chunks()), firsts, rotation)
                for at in range(0, rows.num_rows if part else 0, _AT_ONCE):
                    some = rows.slice(at, _AT_ONCE)
                    tau = some.column("tau").to_numpy()
                    q, x, score = part.search(_matrix(some.column("vec")), rotation, tau, k)
                    taken = some.take(pa.array(q))
                    yield pa.RecordBatch.from_arrays(
                        [taken.column("h1"), taken.column("h2"), pa.array(score), ids.take(pa.array(x))],
                        names,
                    )

    return scan


def usable(vec: Column) -> Column:
    """Not null, not zero, and all components finite numbers."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.isNotNull() & fine & F.exists(vec, lambda x: x != 0)


def nearest(
    table: DataFrame,
    is_query: Column | str,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = NEIGHBOURS,
    n_lists: int | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the largest inner product
    found for each row that ``is_query`` (a condition on the column ``vec_id``) picks.

    Scores are computed on the vectors as given, in double precision, from the first
    dimension on; ties go to the smaller id. All other rows are candidates, and a query
    with fewer than ``k`` gets all. Rows without id, and vectors that are null, empty,
    zero or hold null or non-finite components, take no part, nor do vectors of another
    length than the most frequent one (of equally frequent ones the smallest). A row
    repeated counts once; an id with several vectors keeps the smallest. Equal vectors
    are searched once, under their ``k + 1`` smallest ids, so a vector that many rows
    share is one candidate and one query. An empty table gives an empty result; other
    columns are not read.

    Lists are fitted on at most ``sample_rows`` vectors (and ``SAMPLE_BYTES``), about as
    many as the square root of the number of vectors, at most ``MAX_LISTS``; every
    vector is then put into a list. Centroids are broadcast, at most ``SAMPLE_BYTES``.
    Lists are cut in parts, so the vectors a task holds are bounded. A query first scans
    its nearest lists, which gives it ``k`` neighbours and a threshold, then the others.
    """
    spark = table.sparkSession
    rows = plain_columns(table, vec_id=id_col, vec=vec_col)
    kind = rows.schema["vec"].dataType.elementType
    if not isinstance(kind, T.FloatType):
        rows = rows.withColumn("vec", F.col("vec").cast("array<double>"))
    vec_type = rows.schema["vec"].dataType.simpleString()
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vec")))
    rows = rows.groupBy(F.col("vec_id").cast("bigint").alias("vec_id")).agg(F.min("vec").alias("vec"))
    rows = stored(
        rows.select("vec_id", "vec", F.size("vec").alias("dims"), F.xxhash64(F.lit(1), "vec").alias("h1"), F.xxhash64(F.lit(2), "vec").alias("h2")),
        "vectors",
    )
    lengths = rows.groupBy("dims").agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), "dims").first()
    dims, n = (usual["dims"], usual["n"]) if usual else (1, 0)
    rows = rows.filter(F.col("dims") == dims).drop("dims")

    first_ids = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("vec_id")) <= k + 1
    named = rows.withColumn("first", first_ids).filter("first")
    classes = stored(
        named.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("vec").alias("vec")),
        "vector-classes",
    )
    n_classes = classes.count()
    most = max(1, min(sample_rows, SAMPLE_BYTES // (8 * dims)))
    share = min(1.0, most / max(n_classes, 1))
    drawn = F.pmod(F.xxhash64("h1", "h2"), F.lit(_BUCKETS)) < F.lit(math.ceil(share * _BUCKETS))
    sample = classes.filter(drawn).select("h1", "h2", "vec").limit(2 * most).toArrow()
    sample = sample.sort_by([("h1", "ascending"), ("h2", "ascending")]).slice(0, most)
    if not len(sample):
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    wanted = n_lists or min(MAX_LISTS, math.isqrt(n_classes))
    index = fit(_matrix(sample["vec"].combine_chunks()), max(1, min(wanted, len(sample))))
    fitted = spark.sparkContext.broadcast(index)
    listed = stored(
        classes.mapInArrow(_assigned(fitted), f"list int, radius double, h1 bigint, h2 bigint, ids array<bigint>, vec {vec_type}"),
        "vector-lists",
    )
    index.counts, index.spread = np.zeros(len(index.centroids)), np.zeros(len(index.centroids))
    for row in listed.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.avg("radius").alias("r")).collect():
        index.counts[row["list"]], index.spread[row["list"]] = row["n"], row["r"]
    built = spark.sparkContext.broadcast(index)

    asked = rows.filter(is_query)
    queries = stored(asked.groupBy("h1", "h2").agg(F.first("vec").alias("vec")), "vector-queries")
    parts = F.element_at(F.array(*(F.lit(int(p)) for p in index.parts())), F.col("list") + 1)
    members = listed.select("list", F.pmod(F.xxhash64("h1", "h2"), parts).cast("int").alias("part"), "ids", "vec", F.lit(0).alias("kind"))

    def scan(searching: DataFrame, turn: int) -> DataFrame:
        probes = searching.mapInArrow(_probes(built, k + 1, turn), f"list int, part int, h1 bigint, h2 bigint, vec {vec_type}, tau double")
        met = members.unionByName(probes.withColumn("kind", F.lit(1)), allowMissingColumns=True)
        found = (
            met.repartition("list", "part")
            .sortWithinPartitions("list", "part", "kind")
            .mapInArrow(_scanned(built, k + 1), "h1 bigint, h2 bigint, score double, ids array<bigint>")
        )
        found = found.select("h1", "h2", "score", F.explode("ids").alias("vec_id"))
        return found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)

    best = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "vec_id")
    near = stored(scan(queries.withColumn("tau", F.lit(float("-inf"))), 0), "nearest-lists")
    tau = near.filter(F.col("place") == k + 1).select("h1", "h2", F.col("score").alias("tau"))
    rest = scan(queries.join(tau, ["h1", "h2"], "left").fillna(float("-inf"), ["tau"]), 1)
    found = near.unionByName(rest).withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
    lists = found.groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near"))
    answered = asked.select(F.col("vec_id").alias("query_id"), "h1", "h2").join(lists, ["h1", "h2"])
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return answered.select("query_id", F.posexplode(others).alias("pos", "x")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), "x.vec_id", "x.score"
    )
