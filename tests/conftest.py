from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from tidemark.session import local_session  # noqa: E402
from tidemark.sources import table_stream  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def make_stream(spark, tmp_path):
    """A stream that delivers each list of rows as one file and one micro-batch."""
    made = []

    def make(batches, schema):
        folder = tmp_path / f"input-{len(made)}"
        made.append(folder)
        for i, rows in enumerate(batches):
            add_file(spark, folder, i, rows, schema)
        return table_stream(spark, str(folder), schema, files_per_batch=1)

    make.folders = made
    return make


def add_file(spark, folder, number, rows, schema):
    """Add one parquet file; file times keep the order of delivery."""
    import os

    part = folder.parent / f"{folder.name}-part-{number}"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(part))
    folder.mkdir(exist_ok=True)
    (source,) = part.glob("*.parquet")
    target = folder / f"{number:04d}.parquet"
    target.write_bytes(source.read_bytes())
    os.utime(target, (1_700_000_000 + number, 1_700_000_000 + number))


def rows(df, *columns):
    """Collected rows as sorted tuples."""
    selected = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in selected.collect()), key=repr)
