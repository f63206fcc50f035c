"""Shapes of physical plans: what reaches the scan, what is shuffled, what is not there."""

import re
import subprocess
import sys

import pytest
from compare import DATA
from conftest import ROOT
from pyspark.sql import functions as F

from talkweave.catalog import QUERIES
from talkweave.operators import explore, ordered, rows
from talkweave.plans import cleaning
from talkweave.sources.tables import read_messages, spread, write_table

# these fit models or broadcast a measured side while the plan is made
EAGER = {"boosted_classifier", "boosted_report", "tfidf_top_per_document", "feature_importance", "retrieve_context", "top_k", "top_k_cosine", "retrieved_wide",
         "sampled_energy_distance", "compare_sets", "read_messages", "write_table", "load_predictions"}


# ranked without a partition: block or digit totals only, whose number is bounded
TOTALS_ONLY = {"label_index", "sample_rows"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER - TOTALS_ONLY))
def test_no_cartesian_or_single_task_window(name, spark):
    text = plan(QUERIES[name](spark, str(DATA / "sf0.001")))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    for window in re.findall(r"Window \[.*\], \[(.*?)\](?:,|\n)", text):
        assert window.strip(), f"window without partition in {name}"


def test_filter_and_columns_reach_the_scan(spark):
    docs = read_messages(spark, str(DATA / "sf0.001" / "documents.parquet"), fmt="parquet")
    text = plan(rows.keep_prefix(docs, "source", "src1").select("doc_id"))
    assert "StringStartsWith(source,src1)" in text
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in text


def test_first_n_is_limited_before_the_shuffle(spark):
    docs = spark.read.parquet(str(DATA / "sf0.001" / "documents.parquet"))
    text = plan(explore.first_n_per_class(docs, "source", ["doc_id"], 3))
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_multilabel_split_does_not_shuffle(spark):
    df = spark.createDataFrame([("A. B.", "x, y")], "message string, kind string")
    assert "Exchange" not in plan(rows.split_multilabel(df, "kind"))


def test_runs_move_whole_rows_once(spark):
    df = spark.createDataFrame([(1, 1, "k", "long text")], "s int, at int, k string, text string")
    text = plan(ordered.conversation_runs(df, ["k"], ["at"], ["s"], 10))
    assert sum("text" in line for line in text.splitlines() if "Exchange" in line) == 0  # names are not listed there
    assert len(re.findall(r"Exchange hashpartitioning\(s#\d+, __block", text)) <= 4


def test_spread_leaves_large_scans_alone(spark):
    assert spread(spark.range(100, numPartitions=8), "id").rdd.getNumPartitions() == 8
    assert "Exchange" not in plan(spread(spark.range(100, numPartitions=8), "id"))
    assert spread(spark.range(100, numPartitions=1), "id").rdd.getNumPartitions() == 8


def test_csv_round_trip(spark, tmp_path):
    data = [(1, 'say "hi", then\nleave', " padded "), (2, None, "x\\y"), (3, "", "é")]  # '' reads back as NULL
    df = spark.createDataFrame(data, "i int, a string, b string")
    write_table(df, str(tmp_path / "t"), fmt="csv")
    back = read_messages(spark, str(tmp_path / "t"), df.schema)
    assert sorted(map(tuple, back.collect())) == [*data[:2], (3, None, "é")]


def test_whole_cleaning_of_two_sources(spark):
    one = spark.createDataFrame(
        [("260", "Book Club One", "? F20", "Hi. Ok?", "Social, Seminar", "O-HOT", "x", "x", "1"),
         ("260", "Other", "F20", "gone", "UX", None, "y", "y", "2")],
        "`Book ID` string, Bookclub string, Course string, Message string, R2DiscussionType string,"
        "`R2 Question` string, R1Memo string, Memo string, `Message Time` string",
    )
    two = spark.createDataFrame(
        [("306", "Book Club Two", 1.0, "Ann", "Hello", "UX", "UX", None, None, "Affirm", "Affirm", "2", None),
         ("306", "Book Club Two", 1.0, "Ann", "Last", "UX", "UX", None, None, "Affirm", "Affirm", "3", None)],
        "`Book ID` string, Bookclub string, `User ID` double, Name string, Message string, `SS Discussion Type` string,"
        "`MG Discussion Type` string, `ZH Discussion Type` string, `SS Uptake` string, `MG Uptake` string,"
        "`ZH Uptake` string, `Message Time` string, `NT Uptake` string",
    )
    names = {"Book ID": "book_id", "Bookclub": "bookclub", "Course": "course", "Message": "message",
             "R2DiscussionType": "discussion_type", "R2 Question": "question", "Message Time": "time",
             "Discussion Type": "discussion_type", "Uptake": "uptake", "Pseudonym": "pseudonym"}
    a = cleaning.two_rater_source(one, names, drop=["Memo"])
    b = cleaning.many_rater_source(two, names, drop_last=1, order=["Message Time"], raters=["SS", "MG", "ZH"], drop_prefixes=["Unnamed", "NT"])
    both = cleaning.combined(a, b)
    for c in ("dialogic_spell", "pivot", "uptake", "question", "is_answer"):
        if c not in both.columns:
            both = both.withColumn(c, F.lit(None).cast("string"))
    done = cleaning.clean_messages(both, ["time"], ["source", "book_id"], None, class_names={})
    got = sorted((r.source, r.bookclub, r.message, r.discussion_type, r.uptake, r.pseudonym) for r in done.collect())
    assert got == [
        (1, 1, "Hi.", "Social", None, None),
        (1, 1, "Ok?", "Seminar", None, None),
        (2, 2, "Hello", "UX", "Affirm", "1.0 (Ann)"),
    ]


@pytest.mark.parametrize("name", ["chunk_recursive_rows", "embed", "score", "argmax_label"])
def test_python_runs_once_per_row(name, spark):
    assert plan(QUERIES[name](spark, str(DATA / "sf0.001"))).count("ArrowEvalPython") == 1


def test_workers_need_no_installed_copy(tmp_path):
    """Python functions run on workers that cannot import the package."""
    code = (
        f"import sys; sys.path.insert(0, {str(ROOT)!r})\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "from talkweave.operators.retrieval import chunk_recursive\n"
        "print(chunk_recursive(s.createDataFrame([('a b',)], 'text string'), 'text').count())\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip().endswith("1"), done.stderr[-500:]
