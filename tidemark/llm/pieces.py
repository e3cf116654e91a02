"""SentencePiece encoding and decoding by a max-plus scan over chunks.

The model's merges define which pieces may follow each other: a sequence of pieces is a
text's encoding exactly if the merges leave every pair of neighbours as it is. Encoding
is therefore a best path over the pieces that match the text, where a step weighs 0
between neighbours that may meet and minus infinity otherwise.

A giant document is cut into chunks anywhere. The piece over a cut is the state there;
a chunk yields a matrix of the best weight from each state at its start to each at its
end. Matrices are combined associatively (max-plus product), first in blocks of chunks
and then over blocks, which fixes the state at every cut. Each chunk is then traced
back alone. A document of one chunk has one state at either end.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import plain_columns, stored

SPACE = "▁"
CHUNK = 8192
# Longer texts are cut into chunks that different tasks encode.
GIANT = 32768
# Chunks whose matrices one task combines.
BLOCK = 64
# Encoded segments and judged pairs that a Python worker remembers.
MEMORY = 800_000
START = -2
_UNKNOWN = -1
_NEVER = -np.inf


class Model:
    """Pieces of a byte-fallback merge model with white space kept as it is."""

    def __init__(self, proto: bytes):
        processor = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.pieces: list[str] = []
        self.raw: list[bytes] = []
        self.rank: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids = [0] * 256
        for i in range(processor.vocab_size()):
            piece = processor.id_to_piece(i)
            self.pieces.append(piece)
            if processor.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.raw.append(bytes([value]))
            elif processor.is_control(i) or processor.is_unknown(i):
                self.raw.append(b"")
            else:
                self.raw.append(piece.replace(SPACE, " ").encode())
                self.ids[piece] = i
                self.rank[piece] = processor.get_score(i)
        if processor.normalize("a  béﬁ") != f"{SPACE}a{SPACE}{SPACE}béﬁ":
            raise ValueError("only models that keep text as it is are supported")
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.ids):
            raise ValueError("a piece continues after white space")
        if any("\n" in piece for piece in self.ids):
            raise ValueError("a piece holds a line break")
        self.longest = max(map(len, self.ids))
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self._pairs: dict[int, bool] = {}
        self.segments = _Segments(self)

    def merged(self, text: str) -> list[str]:
        """The pieces that merging neighbours leaves, best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.rank.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging leaves this pair of pieces as it is."""
        if left == _UNKNOWN or right == _UNKNOWN:
            return True
        key = _pair(left, right)
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= MEMORY:
                self._pairs.clear()
            pair = [self.pieces[i] for i in (left, right) if i != START]
            whole = self.ids.get("".join(pair)) if left != START else None
            if whole is not None and self.may_follow(START, whole):
                known = False  # the two merge into one piece
            else:
                known = self.merged("".join(pair)) == pair
            self._pairs[key] = known
        return known

    def forward(self, text: str, origin: int, start: int, stop: int) -> dict[int, tuple[int, int]]:
        """Last piece and its start, by the end of each prefix that can be encoded.

        The path begins after a piece ``origin`` that ends at ``start``; pieces end at
        ``stop`` at the latest.
        """
        last: dict[int, tuple[int, int]] = {start: (origin, start)}
        may_follow, known_pairs = self.may_follow, self._pairs
        seen = start
        for offset, (piece, length) in self.automaton.iter(text, start, stop):
            end = offset + 1
            while seen < offset:  # characters that no piece ends at
                seen += 1
                if seen not in last:
                    self._unknown(text, last, seen)
            begin = end - length
            if begin in last and end not in last:
                left = last[begin][0]
                ok = known_pairs.get((left - START) << 32 | piece)
                if ok is None:
                    ok = may_follow(left, piece)
                if ok:
                    last[end] = (piece, begin)
        while seen < stop:
            seen += 1
            if seen not in last:
                self._unknown(text, last, seen)
        return last

    def _unknown(self, text: str, last: dict, end: int) -> None:
        if end - 1 in last and text[end - 1] not in self.ids:
            last[end] = (_UNKNOWN, end - 1)

    def trace(self, text: str, last: dict, start: int, end: int) -> list[int]:
        """Ids of the path that ``forward`` found from ``start`` to ``end``."""
        ids: list[int] = []
        while end > start:
            piece, begin = last[end]
            if piece == _UNKNOWN:
                data = text[begin:end].encode("utf-8", "surrogatepass")
                ids += [self.byte_ids[b] for b in reversed(data)]
            else:
                ids.append(piece)
            end = begin
        ids.reverse()
        return ids

    def span(self, text: str, origin: int, start: int, end: int) -> list[int]:
        """Ids between a piece ``origin`` ending at ``start`` and the place ``end``."""
        return self.trace(text, self.forward(text, origin, start, end), start, end)

    def segment(self, text: str) -> bytes:
        """Packed ids of a short text between two places that no piece crosses.

        The same path as ``span``, kept in lists because most of the time goes here.
        """
        known, n = self._pairs.get, len(text)
        piece_at: list[int | None] = [None] * (n + 1)
        left_key = [0] * (n + 1)
        size = [0] * (n + 1)
        piece_at[0] = START
        for offset, (piece, length) in self.automaton.iter(text):
            end = offset + 1
            begin = end - length
            if piece_at[end] is None and piece_at[begin] is not None:
                ok = known(left_key[begin] | piece)
                if ok is None:
                    ok = self.may_follow(piece_at[begin], piece)
                if ok:
                    piece_at[end], size[end] = piece, length
                    left_key[end] = (piece - START) << 32
        if piece_at[n] is None:  # it holds characters without a piece
            return array("i", self.span(text, START, 0, n)).tobytes()
        ids = []
        while n:
            ids.append(piece_at[n])
            n -= size[n]
        ids.reverse()
        return array("i", ids).tobytes()

    def whole_segments(self, text: str) -> bytes:
        """Packed ids of a text that begins and ends where no piece can cross."""
        return b"".join(map(self.segments.__getitem__, _SEGMENT.findall(text)))

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text of one chunk."""
        return np.frombuffer(self.whole_segments(marked(text)), np.int32) if text else _NO_IDS

    def decode(self, ids) -> str:
        """The text of a sequence of ids, without the space put first."""
        data = b"".join(map(self.raw.__getitem__, ids))
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def _pair(left: int, right: int) -> int:
    return (left - START) << 32 | right


_NO_IDS = np.empty(0, np.int32)
# No piece crosses from these parts of a text to the next.
_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


class _Segments(dict):
    """Packed ids by segment; segments repeat, so most are encoded once per worker.

    What was not used since the memory last filled up is forgotten.
    """

    def __init__(self, model: Model):
        super().__init__()
        self._model = model
        self._older: dict[str, bytes] = {}

    def __missing__(self, segment: str) -> bytes:
        packed = self._older.get(segment) or self._model.segment(segment)
        if len(segment) <= 64:
            if len(self) >= MEMORY // 2:
                self._older = dict(self)
                self.clear()
            self[segment] = packed
        return packed


def marked(text: str) -> str:
    return SPACE + text.replace(" ", SPACE)


_MODELS: dict[str, Model] = {}


def worker_model(proto: bytes) -> Model:
    """The model, built once per Python worker."""
    name = hashlib.sha256(proto).hexdigest()
    if name not in _MODELS:
        _MODELS[name] = Model(proto)
    return _MODELS[name]


# --- chunks -------------------------------------------------------------------------


def boundaries(text: str) -> list[int]:
    """Places in a text that no piece crosses."""
    return [m.start() for m in _SEGMENT.finditer(text)]


def states(model: Model, text: str, cut: int, first: bool, final: bool) -> list[tuple[int, int]]:
    """The pieces ``(id, end)`` that may hold the character before ``cut``, in order.

    At the ends of a document there is one state: nothing before it or nothing after.
    """
    if first:
        return [(START, cut)]
    if final:
        return [(START, cut)]
    found = []
    low, high = max(cut - model.longest, 0), min(cut + model.longest, len(text))
    for offset, (piece, length) in model.automaton.iter(text, low, high):
        end = offset + 1
        if end - length < cut <= end:
            found.append((piece, end))
    if text[cut - 1] not in model.ids:
        found.append((_UNKNOWN, cut))
    return sorted(found, key=lambda s: (s[1], s[0]))


class Chunk:
    """A stretch of a document with enough text on either side to see its states."""

    def __init__(self, model: Model, text: str, start: int, end: int, first: bool, final: bool):
        self.model, self.text, self.start, self.end, self.final = model, text, start, end, final
        self.entries = states(model, text, start, first, False)
        self.exits = states(model, text, end, False, final)
        self.joints = [b + start - 1 for b in boundaries(text[start - 1 : end]) if b > 0] if start else [
            b for b in boundaries(text[:end])
        ]

    def _paths(self, origin: int, at: int) -> dict:
        """Paths on from a piece, as far as a piece at the end of the chunk can reach."""
        stop = self.end if self.final else min(self.end + self.model.longest, len(self.text))
        return self.model.forward(self.text, origin, at, stop)

    def _reached(self, last: dict) -> np.ndarray:
        if self.final:
            return np.array([0.0 if self.end in last else _NEVER])
        return np.array(
            [
                0.0 if last.get(end, (None,))[0] == piece and last[end][1] < self.end else _NEVER
                for piece, end in self.exits
            ]
        )

    def matrix(self) -> np.ndarray:
        """Best weight from each entry state to each exit state."""
        if not self.joints:
            return np.array([self._reached_from(s) for s in self.entries])
        head, tail = self.joints[0], self.joints[-1]
        into = np.array([0.0 if self._reaches(s, head) else _NEVER for s in self.entries])
        return into[:, None] + self._reached(self._paths(START, tail))[None, :]

    def _reached_from(self, state: tuple[int, int]) -> np.ndarray:
        piece, at = state
        if at >= self.end and not self.final:  # one piece over the whole chunk
            return np.array([0.0 if s == state else _NEVER for s in self.exits])
        return self._reached(self._paths(piece, at))

    def _reaches(self, state: tuple[int, int], place: int) -> bool:
        piece, at = state
        return at == place or (at < place and place in self.model.forward(self.text, piece, at, place))

    def ids(self, entry: int, exit_: int) -> np.ndarray:
        """Ids after the entry state's piece up to the exit state's, that one included."""
        model, text = self.model, self.text
        piece, at = self.entries[entry]
        out = self.exits[exit_][1]
        if not self.joints:
            if at >= self.end and not self.final:
                return _NO_IDS
            return np.array(self._trace(self._paths(piece, at), at, out), np.int32)
        head, tail = self.joints[0], self.joints[-1]
        parts = [
            np.array(model.span(text, piece, at, head), np.int32),
            np.frombuffer(model.whole_segments(text[head:tail]), np.int32),
            np.array(self._trace(self._paths(START, tail), tail, out), np.int32),
        ]
        return np.concatenate(parts)

    def _trace(self, last: dict, start: int, end: int) -> list[int]:
        return self.model.trace(self.text, last, start, end)


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def cut_states(matrices: list[np.ndarray], entry: int, exit_: int) -> list[int]:
    """The best path's state at every cut, from ``entry`` to ``exit_``.

    Forward weights from the entry and backward weights from the exit add up to the
    best path's weight at its states.
    """
    forward = np.full(len(matrices[0]), _NEVER)
    forward[entry] = 0.0
    ahead = [forward]
    for m in matrices:
        ahead.append((ahead[-1][:, None] + m).max(axis=0))
    backward = np.full(matrices[-1].shape[1], _NEVER)
    backward[exit_] = 0.0
    behind = [backward]
    for m in reversed(matrices):
        behind.append((m + behind[-1][None, :]).max(axis=1))
    behind.reverse()
    return [int(np.argmax(f + b)) for f, b in zip(ahead, behind)]


# --- Spark --------------------------------------------------------------------------

_ENCODED = T.StructType(
    [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())]
)


def _id_lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    values = np.concatenate([*arrays, _NO_IDS])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _encode_whole(proto):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(proto.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = part.column(1).to_pylist()
                ids = [model.encode(t) for t in texts]
                same = [model.decode(i.tolist()) == (t or "") for i, t in zip(ids, texts)]
                yield pa.record_batch(
                    [part.column(0), _id_lists(ids), pa.array(same, pa.bool_())],
                    ["doc_id", "ids", "round_trip"],
                )

    return encode


def _split(proto, chunk: int):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = worker_model(proto.value).longest
        for batch in batches:
            for row in range(batch.num_rows):
                text = marked(batch.column(1)[row].as_py())
                cuts = [*range(0, len(text), chunk), len(text)]
                n = len(cuts) - 1
                spans = [(max(a - side, 0), a, b, min(b + side, len(text))) for a, b in zip(cuts, cuts[1:])]
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array([row] * n, pa.int64())),
                        pa.array([row_key(batch, row)] * n, pa.int64()),
                        pa.array(range(n), pa.int64()),
                        pa.array([n] * n, pa.int64()),
                        pa.array([a - low for low, a, _, _ in spans], pa.int32()),
                        pa.array([b - low for low, _, b, _ in spans], pa.int32()),
                        pa.array([text[low:high] for low, _, _, high in spans], pa.string()),
                    ],
                    ["doc_id", "row", "chunk", "n_chunks", "start", "stop", "text"],
                )

    def row_key(batch, row):
        return batch.column(2)[row].as_py()

    return split


def _chunk(model: Model, text: str, start: int, stop: int, chunk: int, n_chunks: int) -> Chunk:
    return Chunk(model, text, start, stop, chunk == 0, chunk == n_chunks - 1)


def _matrices(proto):
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(proto.value)
        for batch in batches:
            rows = batch.select(["text", "start", "stop", "chunk", "n_chunks"]).to_pylist()
            matrices = [_chunk(model, **row).matrix() for row in rows]
            yield pa.record_batch(
                [
                    batch.column("row"),
                    batch.column("chunk"),
                    pa.array([m.shape[1] for m in matrices], pa.int32()),
                    pa.array([m.ravel() for m in matrices], pa.list_(pa.float64())),
                ],
                ["row", "chunk", "width", "weights"],
            )

    return compute


def _trace_back(proto):
    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(proto.value)
        for batch in batches:
            ids, same = [], []
            for row in batch.to_pylist():
                entry, exit_ = row["entry"], row["exit"]
                chunk = _chunk(
                    model, row["text"], row["start"], row["stop"], row["chunk"], row["n_chunks"]
                )
                found = chunk.ids(entry, exit_)
                span = row["text"][chunk.entries[entry][1] : chunk.exits[exit_][1]]
                ids.append(found)
                same.append(b"".join(map(model.raw.__getitem__, found.tolist())).decode("utf-8", "replace") == span.replace(SPACE, " "))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("row"),
                    batch.column("chunk"),
                    _id_lists(ids),
                    pa.array(same, pa.bool_()),
                ],
                ["doc_id", "row", "chunk", "ids", "round_trip"],
            )

    return trace


def _matrix(width: int, weights) -> np.ndarray:
    return np.asarray(weights, float).reshape(-1, width)


def _combine(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("chunk")
    product = None
    for width, weights in zip(rows["width"], rows["weights"]):
        m = _matrix(width, weights)
        product = m if product is None else max_plus(product, m)
    return pd.DataFrame(
        {
            "row": [rows["row"].iloc[0]],
            "block": [rows["block"].iloc[0]],
            "width": [product.shape[1]],
            "weights": [product.ravel().tolist()],
        }
    )


def _block_states(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("block")
    path = cut_states([_matrix(w, x) for w, x in zip(rows["width"], rows["weights"])], 0, 0)
    return pd.DataFrame(
        {"row": rows["row"].values, "block": rows["block"].values, "first": path[:-1], "last": path[1:]}
    )


def _chunk_states(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("chunk")
    path = cut_states(
        [_matrix(w, x) for w, x in zip(rows["width"], rows["weights"])],
        int(rows["first"].iloc[0]),
        int(rows["last"].iloc[0]),
    )
    return pd.DataFrame(
        {"row": rows["row"].values, "chunk": rows["chunk"].values, "entry": path[:-1], "exit": path[1:]}
    )


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode_documents(
    docs: DataFrame,
    proto: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    giant: int = GIANT,
    chunk: int = CHUNK,
) -> DataFrame:
    """``doc_id, ids, round_trip`` per row: the text's ids, and whether they decode to it.

    The ids are those of the model's own encoder. Texts of up to ``giant`` characters
    are encoded where they are read. Longer ones are cut into chunks that any task may
    take, and assembled per document. Null and empty texts have no ids; a null counts
    as empty; repeated rows and null ids stay rows of their own. Texts that hold the
    space mark U+2581 itself decode to spaces, so their round trip is false.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(proto)  # half a megabyte
    doc_type = docs.schema[id_col].dataType.simpleString()
    narrow = plain_columns(docs, doc_id=id_col, text=text_col)
    result = f"doc_id {doc_type}, ids array<int>, round_trip boolean"
    small = narrow.filter(F.coalesce(F.length("text"), F.lit(0)) <= giant).mapInArrow(
        _encode_whole(shared), result
    )
    chunks = (
        narrow.filter(F.length("text") > giant)
        .withColumn("row", F.monotonically_increasing_id())
        .mapInArrow(
            _split(shared, chunk),
            f"doc_id {doc_type}, row bigint, chunk bigint, n_chunks bigint, start int, stop int, text string",
        )
    )
    chunks = stored(chunks, "giant-chunks")  # fixes the row numbers
    return small.unionByName(_encode_chunks(spark, chunks, shared, doc_type))


def _encode_chunks(spark: SparkSession, chunks: DataFrame, shared, doc_type: str) -> DataFrame:
    spread = chunks.repartition("row", "chunk")
    matrices = stored(
        spread.mapInArrow(_matrices(shared), "row bigint, chunk bigint, width int, weights array<double>"),
        "chunk-matrices",
    ).withColumn("block", (F.col("chunk") / BLOCK).cast("bigint"))
    blocks = matrices.groupBy("row", "block").applyInPandas(
        _combine, "row bigint, block bigint, width int, weights array<double>"
    )
    around = blocks.groupBy("row").applyInPandas(
        _block_states, "row bigint, block bigint, first bigint, last bigint"
    )
    cuts = (
        matrices.join(around, ["row", "block"])
        .groupBy("row", "block")
        .applyInPandas(_chunk_states, "row bigint, chunk bigint, entry bigint, exit bigint")
    )
    traced = chunks.join(cuts, ["row", "chunk"]).mapInArrow(
        _trace_back(shared),
        f"doc_id {doc_type}, row bigint, chunk bigint, ids array<int>, round_trip boolean",
    )
    parts = F.sort_array(F.collect_list(F.struct("chunk", "ids")))
    return traced.groupBy("row").agg(  # at most one document
        F.first("doc_id").alias("doc_id"),
        F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"),
        F.every("round_trip").alias("round_trip"),
    ).select("doc_id", "ids", "round_trip")


def decoded(ids: Column, proto: bytes, spark: SparkSession) -> Column:
    """The text of an array of ids; null for null."""
    shared = spark.sparkContext.broadcast(proto)

    @F.pandas_udf(T.StringType())
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = worker_model(shared.value)
        for lists in batches:
            yield pd.Series(
                [None if x is None else model.decode([int(i) for i in x]) for x in lists], dtype=object
            )

    return decode(ids)
