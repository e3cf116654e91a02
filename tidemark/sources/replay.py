"""A stored table replayed as a stream in its order, with a flagged end.

The source's offsets are ranges of an order column. A micro-batch reads the row groups
whose statistics meet its ranges, straight from the stored files: nothing is copied and
file times play no part, so any store that pyarrow can open will do. However ranges
fall into micro-batches, no row comes after a later one's batch.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.functions import END, epoch_ms

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "tidemark_ordered"
# Rows of a range, about; a micro-batch takes one range for each task slot.
ROWS_PER_RANGE = 1_000_000
MAX_RANGES = 10_000
# Ranges per micro-batch; None is one for each task slot.
RANGES_PER_BATCH: int | None = None
# The time of the flagged end, the last day of the year 9999; all rows must be before.
END_MS = 253_402_214_400_000


class _Rows(InputPartition):
    """Row groups of a file that may hold rows of a range; no file is the end row."""

    def __init__(self, file: str | None, groups: Sequence[int] = (), low: int = 0, high: int = 0):
        super().__init__(None)
        self.file, self.groups, self.low, self.high = file, list(groups), low, high


def _number(column):
    """Times as microseconds; whole numbers as they are."""
    if pa.types.is_timestamp(column.type):
        column = column.cast(pa.timestamp("us", column.type.tz))
    return column.cast(pa.int64())


def _stored_number(value) -> int:
    return _number(pa.array([value]))[0].as_py()


class OrderedReader(DataSourceStreamReader):
    """Range ``i`` holds the rows with ``cuts[i] <= order < cuts[i + 1]``; the range behind
    the last is the end row, if one is asked for."""

    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.order = options["path"], options["order"]
        self.cuts = json.loads(options["cuts"])
        self.end = json.loads(options.get("end", "null"))
        self.step = int(options["step"])
        self.at = int(options["start"])
        self.schema = schema
        self.ranges = len(self.cuts) - 1 + (self.end is not None)

    def initialOffset(self) -> dict:
        return {"range": 0}

    def latestOffset(self) -> dict:
        last = len(self.cuts) - 1
        self.at = self.at + self.step
        if self.at >= last:  # the end comes with the last ranges; its time counts from then on
            self.at = self.ranges
        return {"range": self.at}

    def _opened(self):
        if "://" in self.path or self.path.startswith("file:"):
            system, path = pafs.FileSystem.from_uri(self.path)
            return ds.dataset(path, filesystem=system, format="parquet")
        return ds.dataset(self.path, format="parquet")

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        first, behind = start["range"], end["range"]
        self.at = max(self.at, behind)
        found: list[InputPartition] = []
        if first < min(behind, len(self.cuts) - 1):
            edges = self.cuts[first : min(behind, len(self.cuts) - 1) + 1]
            for fragment in self._opened().get_fragments():
                place = fragment.physical_schema.get_field_index(self.order)
                for group in fragment.row_groups:
                    stats = group.statistics.get(self.order) if place >= 0 else None
                    low, high = (
                        (_stored_number(stats["min"]), _stored_number(stats["max"]))
                        if stats and stats.get("min") is not None
                        else (edges[0], edges[-1] - 1)
                    )
                    for a, b in zip(edges, edges[1:]):
                        if low < b and high >= a:
                            found.append(_Rows(fragment.path, [group.id], a, b))
        if self.end is not None and behind == self.ranges and first < self.ranges:
            found.append(_Rows(None))
        return found

    def read(self, partition: InputPartition):
        wanted = to_arrow_schema(self.schema)
        if partition.file is None:
            values = {**{name: None for name in wanted.names}, END: True}
            row = [
                pa.array([self.end[f.name]], pa.int64()).cast(f.type)
                if f.name in self.end
                else pa.array([values[f.name]], f.type)
                for f in wanted
            ]
            yield pa.RecordBatch.from_arrays(row, schema=wanted)
            return
        system = self._opened().filesystem
        fragment = ds.ParquetFileFormat().make_fragment(partition.file, system, row_groups=partition.groups)
        stored = {f.name for f in fragment.physical_schema}
        names = [n for n in {*wanted.names, self.order} if n in stored]
        for batch in fragment.to_batches(columns=names):
            order = _number(batch.column(self.order))
            inside = pc.and_(
                pc.greater_equal(order, partition.low), pc.less(order, partition.high)
            )
            rows = batch.filter(inside)
            if not rows.num_rows:
                continue
            columns = [
                pa.repeat(False, rows.num_rows)
                if f.name == END
                else rows.column(f.name).cast(f.type)
                if f.name in stored
                else pa.nulls(rows.num_rows, f.type)
                for f in wanted
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=wanted)


class OrderedTable(DataSource):
    """A parquet table as a stream of ranges of one of its columns."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return OrderedReader(dict(self.options), schema)


def _as_number(df: DataFrame, order: str):
    column = F.col(f"`{order}`")
    kind = df.schema[order].dataType
    if isinstance(kind, T.TimestampNTZType):
        return epoch_ms(column) * 1000
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    return column.cast("bigint")


def range_cuts(df: DataFrame, order: str, rows_per_range: int = ROWS_PER_RANGE) -> list[int]:
    """Cut points of ranges of about equal row counts; at most ``MAX_RANGES`` ranges.

    Cuts only balance micro-batches; any cuts deliver every row once, in order. Rows
    without order have no place in it and are not delivered.
    """
    number = _as_number(df, order)
    ends = df.agg(F.min(number), F.max(number), F.count(number)).first()
    low, high, n = ends
    if not n:
        return [0, 1]
    slots = df.sparkSession.sparkContext.defaultParallelism
    ranges = min(MAX_RANGES, max(slots, math.ceil(n / rows_per_range)))
    shares = [i / ranges for i in range(1, ranges)]
    inner = df.agg(F.percentile_approx(number, shares, 10 * ranges)).first()[0] if shares else []
    return sorted({low, *inner, high + 1000})  # a time's last millisecond is in


def replay(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    order: str,
    end: dict[str, int] | None = None,
    cuts: Sequence[int] | None = None,
    ranges_per_batch: int | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """The parquet table at ``path`` as a stream that rises with ``order``.

    ``order`` is a whole number or a time (then in microseconds). With ``end`` (values
    of the time columns, as ``order``) a last row follows that is flagged in the
    boolean column ``END`` and null elsewhere; operators let it move the watermark and
    drop it by its flag, so no value is reserved. ``checkpoint`` names the checkpoint
    of a query that goes on where it stopped.
    """
    spark.dataSource.register(OrderedTable)
    cuts = list(cuts) if cuts else range_cuts(spark.read.schema(schema).parquet(path), order)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])  # all nullable
    if end is not None:
        schema = schema.add(END, T.BooleanType())
        if order in end and cuts[-1] > end[order]:
            raise ValueError(f"rows of {path} lie behind the end of time {end[order]}")
    step = ranges_per_batch or RANGES_PER_BATCH or spark.sparkContext.defaultParallelism
    options = {
        "path": path, "order": order, "cuts": json.dumps(cuts), "step": str(step),
        "start": str(_reached(spark, checkpoint) if checkpoint else 0),
    }
    if end is not None:
        options["end"] = json.dumps(end)
    return spark.readStream.format(FORMAT).schema(schema).options(**options).load()


def _reached(spark: SparkSession, checkpoint: str) -> int:
    """The range up to which a checkpoint's offsets go."""
    try:
        logged = spark.read.text(f"{checkpoint}/offsets").filter(F.col("value").startswith('{"range"'))
        found = logged.agg(F.max(F.get_json_object("value", "$.range").cast("int"))).first()[0]
    except Exception as error:  # a checkpoint that no query has written yet
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return 0
    return found or 0
