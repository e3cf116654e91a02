from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from models import word_split
from tidemark import operators as ops
from tidemark.functions import split_words
from tidemark.sinks import latest_values, run_available_now
from tidemark.sources import text_lines, text_stream

LINES = st.lists(st.text(alphabet=" ab\tçß,", max_size=8), min_size=1, max_size=40)


def test_named_cases(spark):
    lines = ["a  b ", "   ", "", " a", "a\tb c", "a"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = [r[0] for r in df.select(split_words(F.col("line"))).collect()]
    assert got == [["a", "", "b"], [], [""], ["", "a"], ["a\tb", "c"], ["a"]]
    assert got == [word_split(x) for x in lines]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(LINES)
def test_split_words_equals_model(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "i long, line string")
    got = [r[0] for r in df.orderBy("i").select(split_words(F.col("line"))).collect()]
    assert got == [word_split(x) for x in lines]


def test_word_count_from_text_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("hello world\nhello \n\n   \n")
    (tmp_path / "b.txt").write_text("world hello  spark\n")
    expected = [("", 2), ("hello", 3), ("spark", 1), ("world", 2)]
    assert rows(ops.word_count(text_lines(spark, str(tmp_path)))) == expected

    updates = run_available_now(
        ops.word_count(text_stream(spark, str(tmp_path), files_per_batch=1)), mode="update"
    )
    assert rows(latest_values(updates, ["word"], "cnt")) == expected


def test_running_word_count(spark):
    documents = spark.createDataFrame([(1, "a b\nb a "), (2, "b  a")], "doc_id long, text string")
    got = rows(ops.running_word_count(ops.document_words(documents)))
    assert got == sorted(
        [
            (1, 0, 0, "a", 1),
            (1, 0, 1, "b", 1),
            (1, 1, 0, "b", 2),
            (1, 1, 1, "a", 2),
            (2, 0, 0, "b", 3),
            (2, 0, 1, "", 1),
            (2, 0, 2, "a", 3),
        ],
        key=repr,
    )
