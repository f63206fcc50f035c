"""Column functions on the nasty values the reference's code has to deal with."""

import pytest
from pyspark.sql import functions as F

from talkweave.functions import labels as L
from talkweave.functions import text as X
from talkweave.functions.stopwords import ENGLISH
from talkweave.sources.predictions import parse_run_name, run_suffix, run_suffix_col
from talkweave.sources.story import html_text, story_pages, story_text

NB = " "


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "fn, values, expected",
    [
        (L.blank_to_null, ["?", " ", NB, "", None, "7", "? "], [None, None, None, "", None, "7", "? "]),
        (L.blank_to_none_label, ["?", NB, None, "Affirm"], ["None", "None", "None", "Affirm"]),
        (L.is_answer, ["No", " ", "", None, "\t\n"], [False, True, False, True, True]),
        (L.strip_marker, ["? F20", "F20", None, "?", ""], ["F20", "F20", None, "", ""]),
        (
            L.number_word,
            ["Book Club One", "Book Club Twenty", "Club Twenty-One", "Ninety-nine", "Other", None, "zero"],
            [1, 20, 21, 99, None, None, 0],
        ),
        (X.strip, [f" {NB}a b\n ", "", None, "x \r\n"], ["a b", "", None, "x"]),
        (
            X.sentences,
            ["A b.  C? D!", "no end", " ", "", None, "e.g. this is"],
            [["A b.", "C?", "D!"], ["no end"], [], [], None, ["e.g.", "this is"]],
        ),
        (X.tokens, ["Don't stop, é1!", "", None], [["Don", "'", "t", "stop", ",", "é1", "!"], [], None]),
        (X.normalise_text, ["Class: 42 Seminar!"], ["class seminar"]),
        (lambda c: L.remap(c, {"a ": "b", "x": None}), ["a ", " a", "x", None, "c"], ["b", "a", None, None, "c"]),
        (lambda c: L.allow_list(c, ["A", "B"]), ["A", "C", None], ["A", "None", "None"]),
        (lambda c: L.allow_list(c, ["A"], other=None), ["A", "C"], ["A", None]),
        (L.as_class, ["a", None], ["a", "None"]),
        (lambda c: L.parse_time(c).cast("string"), ["2024-01-02 03:04:05", "bad", None], ["2024-01-02 03:04:05", None, None]),
        (
            lambda c: L.find_first(c, ["Seminar", "Social", "Se"]),
            ["Class: Social or Seminar", "None of Seminar", "nothing", "", None, "Seminar"],
            ["Social", "None", "None", "None", "None", "Seminar"],
        ),
        (
            lambda c: L.find_first(c, ["Seminar", "Social"]),
            ["the class is seminar", "SOCIAL, not Seminar", "none"],
            ["Seminar", "Social", "None"],
        ),
        (lambda c: L.find_first(c, ["Seminar"], ignore_case=False), ["seminar", "Seminar"], ["None", "Seminar"]),
        (
            lambda c: L.find_first(c, ["art", "start"], whole_word=True),
            ["start art", "cart", "art."],
            ["start", "None", "art"],
        ),
        (
            lambda c: L.parse_delimited(c, ["Affirm", "Elaborate"]),
            ["x // Affirm ", "x // nonsense", "Elaborate or Affirm", "nothing", "x //", None],
            ["Affirm", "nonsense", "Elaborate", "Not Found", "", "Not Found"],
        ),
    ],
)
def test_values(spark, fn, values, expected):
    assert apply(spark, values, fn) == expected


@pytest.mark.parametrize("n, bucket", [(0, 1), (1, 1), (2, 2), (3, 4), (4, 4), (5, 8), (257, 512), (9999, 512)])
def test_length_bucket(spark, n, bucket):
    assert apply(spark, [n], X.length_bucket, "int") == [bucket]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("Delibration to Seminar", ("Deliberation", "Seminar", "from Deliberation to Seminar")),
        ("A to B to C", (None, None, "None")),
        ("Seminar", ("Seminar", None, "None")),
        (" ", (None, None, "None")),
        ("?", (None, None, "None")),
        (None, (None, None, "None")),
        ("A to  B ", ("A", "B", "from A to B")),
    ],
)
def test_pivot(spark, value, expected):
    a, b = L.pivot_ends(F.lit(value).cast("string"), {"Delibration": "Deliberation"})
    assert tuple(spark.range(1).select(a, b, L.pivot_text(a, b)).first()) == expected


@pytest.mark.parametrize(
    "votes, mode",
    [(["a", "b", "b"], "b"), (["b", "a", None], "a"), ([None, None, None], None), (["c", "b", "a"], "a")],
)
def test_row_mode(spark, votes, mode):
    df = spark.createDataFrame([tuple(votes)], "x string, y string, z string")
    assert df.select(L.row_mode(["x", "y", "z"])).first()[0] == mode


def test_argmax_first_on_ties(spark):
    df = spark.createDataFrame([([0.1, 0.5, 0.5],), ([1.0, 0.0, 0.0],)], "s array<double>")
    got = [r[0] for r in df.select(L.argmax_label("s", ["x", "y", "z"])).collect()]
    assert got == ["y", "x"]


def test_one_hot_missing(spark):
    assert apply(spark, ["b", None], lambda c: L.one_hot(c, ["a", "b"])) == [[0, 1], [0, 0]]


def test_strict_time_raises(spark):
    with pytest.raises(Exception):
        apply(spark, ["bad"], lambda c: L.parse_time(c, lenient=False))


def test_combine(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    assert df.select(X.combine_fields(["x", "y", "z"], "|"), X.id_with_name("z", "y")).first() == ("a|3", None)


def test_stop_words():
    assert len(ENGLISH) == len(set(ENGLISH)) == 179


@pytest.mark.parametrize(
    "args, name",
    [
        (("Uptake",), "_uptake"),
        (("Uptake", True, True, True, "x"), "_uptake_w_history_past-labels_context_x"),
        (("Discussion", False, False, True), "_discussion_w_context"),
    ],
)
def test_run_suffix(spark, args, name):
    assert run_suffix(*args) == name
    full = [*args, *[False] * (4 - len(args))][:4]
    extra = args[4] if len(args) > 4 else None
    cols = [F.lit(a) for a in full] + [F.lit(extra).cast("string")]
    assert spark.range(1).select(run_suffix_col(*cols)).first()[0] == name


def test_run_suffix_needs_history():
    with pytest.raises(ValueError):
        run_suffix("Uptake", False, True)


@pytest.mark.parametrize(
    "name, parts",
    [
        ("mistral-7B_discussion_w_history_context.npy", ("mistral-7B", "discussion", True, False, True)),
        ("xgboost.npy", ("xgboost", None, False, False, False)),
        ("llamaForClassification__discussion_w_history_past-labels.npy", ("llamaForClassification", None, True, True, False)),
    ],
)
def test_parse_run_name(spark, name, parts):
    assert tuple(spark.range(1).select(*parse_run_name(F.lit(name))).first()) == parts


BOOK = """<?xml version="1.0"?><book><discussion><topic><text>no</text></topic></discussion>
<page type_id="1" hidden="n"><state><text><![CDATA[<p></p>
<p>One & two.</p>

<p>Three</p>]]></text></state></page>
<page type_id="2"><state><image/></state></page>
<page type_id="3"><state><text>first</text></state><state><text>second</text></state></page>
</book>"""


def test_story(spark):
    df = spark.createDataFrame([(BOOK,)], "xml string").select(story_pages("xml").alias("p"))
    row = df.select("p", story_text("p").alias("t")).first()
    assert [(p.page_no, p.type_id) for p in row.p] == [(1, "1"), (2, "2"), (3, "3")]
    assert row.p[1].text == "" and row.p[2].text == "first"
    assert row.t == "One & two.\nThree\nfirst"


def test_html(spark):
    html = "<html><title>T &amp; x</title><style>a{}</style><script>b<c</script><!-- <p>no --><p>Hi&nbsp;<b>you</b> &lt;3</p>"
    assert apply(spark, [html], html_text) == ["T & x Hi you <3"]
