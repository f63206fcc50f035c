"""Operators on small frames: hand-written expectations, brute force and properties."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from talkweave.catalog import QUERIES
from talkweave.operators import agreement as A
from talkweave.operators import blocks as B
from talkweave.operators import evaluate as E
from talkweave.operators import explore as X
from talkweave.operators import features as K
from talkweave.operators import joins as J
from talkweave.operators import ordered as O
from talkweave.operators import prompts as P
from talkweave.operators import retrieval as R
from talkweave.operators import rows
from talkweave.operators import schema as S
from talkweave.operators import scoring as M
from talkweave.operators import shift as D
from talkweave.operators import splits as H


# --- ordered work in blocks -------------------------------------------------


def posts(seed=1, n=300, hot=0.5):
    """Rows of five sources, one holding half of them, with returning and NULL run keys."""
    rng = random.Random(seed)
    times = rng.sample(range(10 * n), n)
    out = []
    for i in range(n):
        src = "hot" if rng.random() < hot else rng.choice(["a", "b", "c", None])
        label = rng.choice(["x", "y", None])
        out.append((i, src, times[i], rng.choice(["k1", "k2", None]), f"t{i}", label))
    return out


SCHEMA = "id int, src string, at int, band string, text string, label string"


def by_source(data):
    groups = defaultdict(list)
    for r in sorted(data, key=lambda r: r[2]):
        groups[r[1]].append(r)
    return groups.values()


@pytest.mark.parametrize("width", [None, 7, 40, 400, 100_000, "auto"])
@pytest.mark.parametrize("k", [1, 3, 6])
def test_history_any_block(spark, width, k):
    data = posts()
    df = spark.createDataFrame(data, SCHEMA)
    got = O.history(df, "text", ["at"], ["src"], k, "label", ["band"], width)
    got = {r.id: [(h.text, h.label) for h in r.history] for r in got.collect()}
    want = {}
    for group in by_source(data):
        past, before = [], object()
        for r in group:
            if r[3] != before:
                past = []
            want[r[0]] = past[-k:]
            past, before = past + [(r[4], r[5])], r[3]
    assert got == want


@pytest.mark.parametrize("width", [None, 7, 400, "auto"])
def test_runs_and_positions_any_block(spark, width):
    data = posts(2)
    df = spark.createDataFrame(data, SCHEMA)
    runs = {r.id: r.run for r in O.conversation_runs(df, ["band"], ["at"], ["src"], width).collect()}
    seats = {r.id: r.row_id for r in rows.with_row_id(df, ["at"], ["src"], width).collect()}
    sized = B.row_position(df, ["src"], ["at"], width, "pos", group_size="n").collect()
    want_run, want_seat, want_n = {}, {}, {}
    for group in by_source(data):
        run, before = 0, object()
        for i, r in enumerate(group):
            run += r[3] != before
            before = r[3]
            want_run[r[0]], want_seat[r[0]], want_n[r[0]] = run, i, len(group)
    assert runs == want_run
    assert seats == want_seat
    assert {r.id: r.n for r in sized} == want_n
    assert {r.id: r.pos - 1 for r in sized} == want_seat


@pytest.mark.parametrize("width", [None, 25, "auto"])
def test_previous_row_values(spark, width):
    data = posts(3)
    df = spark.createDataFrame(data, SCHEMA)
    prev = {r.id: r.prev_message for r in O.prev_message(df, "text", ["at"], ["src"], ["band"], width).collect()}
    piv = {r.id: (r.from_pivot, r.to_pivot) for r in O.derive_pivot(df, "label", ["at"], ["src"], block=width).collect()}
    cats = O.prev_categories(df, ["label", "id"], ["at"], ["src"], 3, ["band"], width)
    cats = {r.id: r.prev_categories for r in cats.collect()}
    for group in by_source(data):
        past = []
        for i, r in enumerate(group):
            same = i > 0 and group[i - 1][3] == r[3]
            past = past if same else []
            assert prev[r[0]] == (group[i - 1][4] if same else "")
            assert cats[r[0]] == "|".join(past[-3:])
            past = past + [f"{r[5] or ''}-{r[0]}"]
            a, b = (group[i - 1][5] if i else None), r[5]
            assert piv[r[0]] == ((a, b) if a and b and a != b else (None, None))


def test_unbounded_history_and_errors(spark):
    df = spark.createDataFrame(posts(4, 40), SCHEMA)
    got = O.history(df, "text", ["at"], ["src"], k=-1).collect()
    sizes = Counter(len(r.history) for r in got)
    assert max(sizes) == max(Counter(r.src for r in got).values()) - 1
    with pytest.raises(ValueError):
        O.label_history(df, "text", "missing", ["at"], ["src"])
    with pytest.raises(TypeError):
        B.order_block(df, "text", 3)


def test_quantile_blocks(spark):
    # a burst that holds most rows, and values spread thinly over a wide range
    df = spark.range(20_000).select("id", F.when(F.col("id") < 15_000, F.col("id")).otherwise(F.col("id") * 1_000_003).alias("at"))
    cut = B.add_block(df, ["at"], B.AUTO)
    sizes = cut.groupBy(B.BLOCK).agg(F.count("*").alias("n"), F.min("at").alias("a"), F.max("at").alias("b")).orderBy(B.BLOCK).collect()
    assert max(r.n for r in sizes) < 200 and len(sizes) <= B.SPLITS
    assert all(x.b < y.a for x, y in zip(sizes, sizes[1:]))
    words = df.select(F.concat(F.lit("w"), F.md5(F.col("id").cast("string"))).alias("w"))
    texts = B.add_block(words, ["w"], B.AUTO).groupBy(B.BLOCK).agg(F.count("*").alias("n"), F.min("w").alias("a"), F.max("w").alias("b"))
    sizes = texts.orderBy(B.BLOCK).collect()
    assert max(r.n for r in sizes) < 200 and all(x.b < y.a for x, y in zip(sizes, sizes[1:]))
    assert B.add_block(df.limit(0), ["at"], B.AUTO).count() == 0


def test_check_pivot(spark):
    data = [
        (1, 1, "Seminar", "Seminar", "Social/Procedure/UX"),  # opens the conversation
        (1, 2, "UX", "Seminar", "Social/Procedure/UX"),
        (1, 3, "Seminar", "Seminar", "Deliberation"),
        (1, 4, "unlisted", "Seminar", "Seminar"),
        (2, 1, "UX", None, None),
        (2, 2, "Seminar", "Social/Procedure/UX", "Seminar"),
    ]
    groups = {"Seminar": "Seminar", "UX": "Social/Procedure/UX"}
    df = spark.createDataFrame(data, "c int, t int, kind string, a string, b string")
    done = O.check_pivot(df, "kind", "a", "b", ["t"], ["c"], groups)
    got = {(r.c, r.t): r.pivot_check for r in done.collect()}
    assert got == {(1, 1): None, (1, 2): "corrected", (1, 3): "misplaced", (1, 4): None, (2, 1): None, (2, 2): "corrected"}
    assert O.pivot_check_summary(done).first()[:2] == (2, 1)


# --- rows -------------------------------------------------------------------

LABELLED = "id int, message string, kind string, question string, pivot string"


def test_split_multilabel(spark):
    data = [
        (1, "One. Two?", "A, B", "q1, q2", "p"),
        (2, "One. Two. Three.", "A,A", "q", "p"),
        (3, "One.", "A, B", None, "p"),
        (4, "One. Two.", "A", "q1,q2", "p"),
        (5, "One. Two.", None, "q", "p"),
        (6, None, "A, B", "q", "p"),
        (7, "One. Two.", "A, A", "", "p"),
    ]
    df = spark.createDataFrame(data, LABELLED)
    got = rows.split_multilabel(df, "kind", "message", ["question"], ["pivot"], "Other")
    got = [tuple(r) for r in got.orderBy("id", "part_no").collect()]
    assert got == [
        (1, "One.", "A", "q1", None, 0),
        (1, "Two?", "B", "q2", "p", 1),
        (2, "One. Two. Three.", "A", "q", "p", 0),
        (3, "One.", "Other", None, "p", 0),
        (4, "One. Two.", "A", "q1,q2", "p", 0),
        (5, "One. Two.", None, "q", "p", 0),
        (6, None, "Other", "q", "p", 0),
        (7, "One.", "A", "", None, 0),
        (7, "Two.", "A", "", "p", 1),
    ]
    twice = rows.split_multilabel(df, "kind", "message", ["question"], ["pivot"], mode="duplicate")
    twice = [tuple(r)[1:] for r in twice.filter("id = 3").orderBy("part_no").collect()]
    assert twice == [("One.", "A", None, None, 0), ("One.", "B", None, "p", 1)]


def test_drop_tail(spark):
    df = spark.createDataFrame(posts(5), SCHEMA)
    got = {r.id for r in rows.drop_tail(df, 3, ["at"], ["src"]).collect()}
    assert got == {r[0] for g in by_source(posts(5)) for r in g[:-3]}
    last = sorted(posts(5), key=lambda r: r[2])[-2:]
    assert {r[0] for r in posts(5)} - {r.id for r in rows.drop_tail(df, 2, ["at"]).collect()} == {r[0] for r in last}


def test_drop_tail_with_ties(spark):
    data = [(1, "a", 5), (2, "a", 5), (3, "a", 5), (4, "a", 1), (4, "a", 1), (5, None, 7), (5, None, 7), (5, None, 7)]
    df = spark.createDataFrame(data, "id int, src string, at int")
    for n, left in ((1, {"a": 4, None: 2}), (2, {"a": 3, None: 1}), (4, {"a": 1}), (9, {})):
        got = rows.drop_tail(df, n, ["at"], ["src"]).groupBy("src").count().collect()
        assert {r.src: r["count"] for r in got} == left
        assert rows.drop_tail(df, n, ["at"]).count() == max(0, len(data) - n)


def test_filters(spark):
    df = spark.createDataFrame([("Book a",), ("Other",), (None,)], "c string")
    assert [r.c for r in rows.keep_prefix(df, "c", "Book").collect()] == ["Book a"]
    assert {r.c for r in rows.filter_ne(df, "c", "Other").collect()} == {"Book a", None}
    assert [r.c for r in rows.outside_allow_list(df, "c", ["Other"]).collect()] == ["Book a"]


def test_corrections_replace_first_match_only(spark):
    df = spark.createDataFrame([(2, "Hi all", "x"), (1, "Hi you", "x"), (3, "Bye", "x")], "i int, m string, l string")
    got = rows.apply_corrections(df, [("Hi", 2, "you", "B"), ("Hi", 1, "Hi", "A")], "m", "l", ["i"])
    assert sorted(map(tuple, got.collect())) == [
        (1, "Hi", "A", 0), (1, "you", "B", 1), (2, "Hi all", "x", 0), (3, "Bye", "x", 0),
    ]


def test_corrections_with_ties(spark):
    df = spark.createDataFrame([(1, "Hi a", "x"), (1, "Hi b", "x"), (1, "Hi b", "x"), (1, "Bye", "x"), (1, "Bye", "x")], "i int, m string, l string")
    got = rows.apply_corrections(df, [("Hi", 1, "new", "A"), ("Bye", 1, "old", "B")], "m", "l", ["i"]).collect()
    assert sorted(r.m for r in got if r.m in ("new", "old")) == ["new", "old"] and len(got) == 5


# --- schema -----------------------------------------------------------------


def test_schema_operators(spark):
    df = spark.createDataFrame(
        [(1, "a", "a", None, "a"), (2, None, None, "b", "x")],
        "`R1 U` int, u string, v string, `u.1` string, `R2 U` string",
    )
    assert S.drop_equal_columns(df).columns == ["R1 U", "u", "u.1", "R2 U"]
    assert S.drop_prefixed(df, ["R1"]).columns == ["u", "v", "u.1", "R2 U"]
    assert S.suffix_duplicate_report(df).first() == Row(column="u", only_in_duplicate=1)
    assert S.drop_suffix_duplicates(df).columns == ["R1 U", "u", "v", "R2 U"]
    assert S.camel_columns(df.select(F.col("u").alias("message time"), F.col("v").alias("Is Answer"))).columns == ["MessageTime", "IsAnswer"]
    cols = ["R1Up", "R2Up", "BinaryR1X", "BinaryR2X", "R1Only", "R2Other"]
    assert S.rater_pairs(cols) == [("R1Up", "R2Up"), ("BinaryR1X", "BinaryR2X")]
    a, b = S.align_schemas(df, df.select("v", "u", F.lit(1).alias("w")))
    assert a.columns == b.columns == ["u", "v"]
    assert S.cast_columns(df, {"u": "int"}).filter("u is not null").count() == 0


# --- exploration and agreement ----------------------------------------------


def test_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "c string")
    assert {(r.c, r["count"], r.share) for r in X.value_share(df, "c").collect()} == {("a", 2, 0.5), (None, 1, 0.25), ("b", 1, 0.25)}
    assert {(r.c, r["count"]) for r in X.value_counts(df, "c").collect()} == {("a", 2), ("b", 1)}
    assert [tuple(r) for r in X.top_n_counts(df, "c", 1).collect()] == [("a", 2)]


def test_histogram_edges(spark):
    df = spark.range(101).select(F.col("id").alias("x"))
    got = {r.bin: r["count"] for r in X.histogram(df, F.col("x"), 10).collect()}
    assert got == {**{i: 10 for i in range(9)}, 9: 11}
    flat = spark.range(3).select(F.lit(5).alias("x"))
    assert [tuple(r)[:2] for r in X.histogram(flat, F.col("x")).collect()] == [(0, 3)]


def test_row_term_counts(spark):
    df = spark.createDataFrame([(1, "b a b"), (2, ""), (3, None), (4, "É é")], "i int, t string")
    got = {tuple(r) for r in X.row_term_counts(df, "t", ["i"]).collect()}
    assert got == {(1, "a", 1), (1, "b", 2), (4, "é", 2)}


def test_tfidf_same_with_and_without_row_documents(spark):
    df = spark.createDataFrame([(1, "aa bb aa"), (2, "bb cc"), (3, "dd")], "i int, t string")
    a = {(r.i, r.term, round(r.tfidf, 9)) for r in X.tfidf(df, "t", "i").collect()}
    b = {(r.i, r.term, round(r.tfidf, 9)) for r in X.tfidf(df, "t", "i", doc_is_row=True).collect()}
    assert a == b
    norms = defaultdict(float)
    for i, _, x in a:
        norms[i] += x * x
    assert all(abs(n - 1) < 1e-6 for n in norms.values())


def kappa(a, b):
    n = len(a)
    po = sum(x == y for x, y in zip(a, b)) / n
    ca, cb = Counter(a), Counter(b)
    pe = sum(ca[k] * cb[k] for k in ca) / n / n
    return None if pe == 1 else (po - pe) / (1 - pe)


def test_kappa(spark):
    rng = random.Random(6)
    data = [tuple(rng.choice(["x", "y", None]) for _ in range(2)) + ("x",) for _ in range(60)]
    df = spark.createDataFrame(data, "a string, b string, c string").withColumn("d", F.col("a")).withColumn("e", F.lit("x"))
    got = {(r.rater_a, r.rater_b): r.kappa for r in A.pairwise_kappa(df, list("abcde")).collect()}
    cols = dict(zip("abc", zip(*data)))
    assert got["a", "b"] == pytest.approx(kappa(*[[v or "nan" for v in cols[c]] for c in "ab"]))
    assert got["a", "d"] == pytest.approx(1.0)
    assert got["c", "e"] is None
    assert len(got) == 10


# --- splits -----------------------------------------------------------------


def test_stratified_split(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, "b").alias("label"))
    got = H.stratified_split(df, "id", "label").groupBy("label").pivot("split", ["train", "validation", "test"]).count()
    got = {r.label: (r.train, r.validation, r.test) for r in got.collect()}
    assert got == {"hot": (420, 140, 140), "b": (120, 40, 40), None: (60, 20, 20)}
    same = H.stratified_split(df.repartition(7), "id", "label").exceptAll(H.stratified_split(df, "id", "label"))
    assert same.isEmpty()
    with pytest.raises(ValueError):
        H.stratified_split(df, "id", "label", {"a": 0.5, "b": 0.4})


def test_stratified_split_with_many_labels(spark):
    df = spark.range(12_000).select("id", F.concat(F.lit("label "), (F.col("id") % 1200).cast("string")).alias("label"))
    sizes = H.stratified_split(df, "id", "label").groupBy("label", "split").count().groupBy("split", "count").count().collect()
    assert {(r.split, r[1], r[2]) for r in sizes} == {("train", 6, 1200), ("validation", 2, 1200), ("test", 2, 1200)}


def test_random_split_is_stable(spark):
    df = spark.range(2000)
    split = H.random_split(df, "id")
    assert split.exceptAll(H.random_split(df.repartition(5), "id")).isEmpty()
    assert 1500 < split.filter("split = 'train'").count() < 1700
    assert H.merge_splits(split).filter("split != 'train'").isEmpty()


# --- joins ------------------------------------------------------------------


def test_join_on_text_weights(spark):
    a = spark.createDataFrame([("t", 1), ("t", 1), ("t", 2), ("u", 1), (None, 1)], "text string, x int")
    b = spark.createDataFrame([("t", "p"), ("t", "p"), ("v", "q"), (None, "q")], "text string, y string")
    got = {tuple(r) for r in J.join_on_text(a, b, "text", ["x"], ["y"]).collect()}
    assert got == {("t", 1, "p", 4), ("t", 2, "p", 2)}
    left = J.exclude_examples(a, b, "text").select("text").collect()
    assert sorted(str(r.text) for r in left) == ["None", "u"]


def test_attach_context(spark):
    rows_ = spark.createDataFrame([(1,), (2,)], "row_id int")
    ctx = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 3, "c")], "row_id int, rank int, text string")
    got = {r.row_id: r.context for r in J.attach_context(rows_, ctx).collect()}
    assert got == {1: ["a", "b"], 2: []}


# --- chunks and nearest passages ---------------------------------------------


@pytest.mark.parametrize("seed", range(5))
def test_recursive_chunks(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["word ", "longerword ", "x", "\n", "\n\n", ". "]) for _ in range(1500))
    text += "".join(rng.choices("abcdefghij", k=1200))
    chunks = R.split_recursive(text, 500, 30)
    assert all(0 < len(c) <= 500 for c in chunks)
    pos = 0
    for c in chunks:  # in order, and every visible character is covered
        at = text.find(c, max(0, pos - 60))
        assert at >= 0 and not text[pos:at].strip()
        pos = max(pos, at + len(c))
    assert not text[pos:].strip()


def test_recursive_chunk_values():
    assert R.split_recursive("aaa bbb ccc", 7, 0) == ["aaa bbb", "ccc"]
    assert R.split_recursive("aaa bbb ccc", 8, 4) == ["aaa bbb", "bbb ccc"]
    assert R.split_recursive("para one\n\npara two", 10, 0) == ["para one", "para two"]
    assert R.split_recursive("abcdef", 3, 1) == ["abc", "cde", "ef"]
    assert R.split_recursive("", 3, 1) == []


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("limit", [1 << 30, 1500, 200])
def test_top_k_all_shapes(spark, metric, limit):
    """Broadcast vectors, broadcast queries and blocks give the brute-force answer."""
    rng = np.random.default_rng(7)
    v = rng.integers(-2, 3, (50, 3)).astype(float)
    v[7] = v[3]
    q = rng.integers(-2, 3, (20, 3)).astype(float) + 0.5
    v += 0.25
    vec = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    que = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], "query_id long, embedding array<double>")
    got = defaultdict(list)
    for r in R.top_k(que, vec, 4, metric, limit).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, round(r.distance, 9)))
    for i, x in enumerate(q):
        if metric == "l2":
            d = np.sqrt(((v - x) ** 2).sum(axis=1))
        else:
            d = 1 - (v @ x) / np.linalg.norm(v, axis=1) / np.linalg.norm(x)
        assert [d_ for _, d_ in got[i]] == [round(y, 9) for y in sorted(d)[:4]]
        if metric == "l2":
            assert [j for j, _ in got[i]] == [j for _, j in sorted((y, j) for j, y in enumerate(d))][:4]


def test_embed_hashed_unit_length(spark):
    df = spark.createDataFrame([("a b a",), ("",)], "t string")
    got = [sum(x * x for x in r.embedding) for r in R.embed_hashed(df, "t", 32).collect()]
    assert got[0] == pytest.approx(1, abs=1e-6) and got[1] == 0


# --- features, prompts, scoring ----------------------------------------------


def test_embedding_sum(spark):
    docs = spark.createDataFrame([(1, "a b a zz"), (2, "zz"), (3, None)], "i int, t string")
    vec = spark.createDataFrame([("a", [1.0, 0.5]), ("b", [0.0, 2.0])], "word string, vector array<double>")
    got = {r.i: (r.embedding, r.known_words) for r in K.embedding_sum(docs, vec, "t", "i", 2).collect()}
    assert got == {1: ([2.0, 3.0], 3), 2: ([0.0, 0.0], 0), 3: ([0.0, 0.0], 0)}
    assert {tuple(r) for r in K.unknown_words(docs, vec, "t", "i").collect()} == {("zz", 2)}


def test_class_weights_and_index(spark):
    df = spark.createDataFrame([("b",), ("b",), ("b",), (None,)], "l string")
    assert {r.label: r.weight for r in K.class_weights(df, "l").collect()} == {"b": 4 / 6, "None": 2.0}
    assert {tuple(r) for r in K.label_index(df, "l").collect()} == {("None", 0), ("b", 1)}


def test_prompt_rules(spark):
    df = spark.createDataFrame([("new", [("old", None)])], "t string, history array<struct<text:string,label:string>>")

    def roles(**kw):
        p = P.build_prompts(df, "t", F.lit("B"), F.array(F.lit("c")), **kw).first().prompt
        return [m.role for m in p], p

    assert roles(style="system")[0] == ["system", "user", "assistant", "user"]
    assert roles(style="system")[1][2].content == "Class: None"
    assert roles(style="system", use_past_labels=False)[0] == ["system", "user", "user"]
    shape, p = roles(style="user", use_past_labels=False)
    assert shape == ["user", "assistant", "user"] and p[0].content.endswith("\nold")
    _, p = roles(style="user", use_history=False, use_past_labels=False)
    assert "old" not in p[0].content
    with pytest.raises(ValueError):
        roles(use_history=False, use_past_labels=True)


def test_ensemble_replaces_first_line(spark):
    df = spark.createDataFrame([([("system", "one\ntwo"), ("user", "q")], None, "B")], f"p {P.MESSAGES}, r1 string, r2 string")
    p = df.select(P.ensemble_prompt("p", ["r1", "r2"]).alias("x")).first().x
    assert [m.role for m in p] == ["system", "user", "assistant", "user"]
    assert p[0].content.endswith("predictions.\ntwo") and "one" not in p[0].content.split("\n")
    assert "Expert r2 categorized the sentence as class: B.\n" in p[3].content


def test_vote(spark):
    data = [(1, "a", "x"), (1, "b", "y"), (2, "a", "x"), (2, "b", None), (3, "a", None), (4, "a", "y"), (4, "b", "y"), (4, "c", "x")]
    df = spark.createDataFrame(data, "row_id int, run_id string, label string")
    assert {r.row_id: r.label for r in M.vote(df).collect()} == {1: "x", 2: "x", 3: None, 4: "y"}
    weighted = M.vote(df, weights={"b": 2.0}).collect()
    assert {r.row_id: r.label for r in weighted}[1] == "y"


def test_metrics_equal_spark_ml(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator as Ev

    rng = random.Random(8)
    data = [(rng.randrange(4), rng.randrange(3)) for _ in range(400)]
    df = spark.createDataFrame(data, "y int, p int")
    got = E.summary_metrics(df.selectExpr("cast(y as string) y", "cast(p as string) p"), "y", "p").first()
    ml = df.selectExpr("cast(y as double) label", "cast(p as double) prediction")
    for name, metric in (("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")):
        assert got[name] == pytest.approx(Ev(metricName=metric).evaluate(ml))
    report = {r["class"]: r for r in E.classification_report(df, "y", "p").collect()}
    assert set(report) == {"0", "1", "2", "3", "accuracy", "macro avg", "weighted avg"}
    assert report["3"].precision == 0 and report["accuracy"].support == 400


def test_set_distance(spark):
    rng = np.random.default_rng(9)
    mk = lambda m, o: spark.createDataFrame(
        [(i + o, (rng.normal(m, 1, 4)).tolist(), "ab"[i % 2]) for i in range(80)],
        "id int, v array<double>, label string",
    ).cache()
    a, b, far = mk(0, 0), mk(0, 100), mk(3, 200)
    near_d = D.sampled_energy_distance(a, b, "id", "v").first().distance
    far_d = D.sampled_energy_distance(a, far, "id", "v").first().distance
    assert D.sampled_energy_distance(a, a, "id", "v").first().distance == pytest.approx(0, abs=1e-9)
    assert abs(near_d) < 0.3 < far_d
    assert D.compare_sets(a, far, ["label"], "v").count() == 5


def test_energy_distance_over_all_rows(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(0, 1, (70, 3)).round(1), rng.normal(0.7, 2, (50, 3)).round(1)
    y[:20] = y[0]  # ties
    frame = lambda m: spark.createDataFrame([(r.tolist(),) for r in m] + [(None,)], "v array<double>").repartition(5)
    total = 0.0
    for d in range(16):
        u = np.sin((np.arange(3) + 1) * (12.9898 * (d + 1)))
        p, q = x @ u / np.linalg.norm(u), y @ u / np.linalg.norm(u)
        mean = lambda s, t: np.abs(s[:, None] - t[None, :]).mean()
        total += 2 * mean(p, q) - mean(p, p) - mean(q, q)
    assert D.energy_distance(frame(x), frame(y), "v").first().distance == pytest.approx(total / 16)
    assert D.energy_distance(frame(x), frame(x), "v").first().distance == pytest.approx(0, abs=1e-12)
    assert D.energy_distance(frame(x), frame(x[:0]), "v").first().distance is None


@pytest.mark.parametrize("name", ["top_k", "top_k_cosine", "retrieved_wide"])
def test_every_vector_asks_and_answers(spark, tmp_path, name):
    """Each vector, whatever its id, is a question and may be an answer."""
    rng = np.random.default_rng(5)
    data = [(i, [float(x) for x in rng.integers(1, 99, 4)], 0) for i in range(1, 40)]
    spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = QUERIES[name](spark, str(tmp_path)).collect()
    assert {r.query_id for r in got} == {i for i, *_ in data}
    first = {r.query_id: r.doc_1 for r in got} if name == "retrieved_wide" else {r.query_id: r.vec_id for r in got if r.rank == 1}
    assert len(got) == (39 if name == "retrieved_wide" else 39 * 5) and all(a == b for a, b in first.items())
