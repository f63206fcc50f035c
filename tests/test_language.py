"""Spelling and abbreviations against plain Python."""

import math
import random
import re
from collections import Counter

import duckdb
from compare import DATA
from pyspark.sql import functions as F

from talkweave.functions.labels import find_first
from talkweave.functions.text import sentences as plain_sentences
from talkweave.functions.text import tokens
from talkweave.operators import abbreviations as A
from talkweave.operators import rows as R
from talkweave.operators import spelling as S
from talkweave.operators import stemming as ST
from talkweave.operators import word_pieces as WP


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, left = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(left[j] + 1, row[-1] + 1, left[j - 1] + (x != y)))
    return row[-1]


def column(spark, words):
    return spark.createDataFrame([(w,) for w in words], "word string")


def test_all_near_pairs(spark):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdé字") for _ in range(n))
    base = [word(rng.randrange(0, 9)) for _ in range(60)] + [word(n) for n in range(21, 32) for _ in range(2)] + [word(300)]

    def edited(w):
        w = list(w)
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(w) + 1)
            w[i : i + rng.randrange(2)] = rng.choice(["", "x", "a"])
        return "".join(w)

    other = [edited(w) for w in base for _ in range(3)]
    for d in (1, 2):
        got = S.near_words(column(spark, [*base, None, base[0]]), column(spark, [*other, None]), d).collect()
        want = {(a, b, distance(a, b)) for a in base for b in other if distance(a, b) <= d}
        assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_corrections_by_distance_count_and_name(spark):
    known = spark.createDataFrame([("seminar", 5), ("social", 9), ("sociak", 2), ("cat", 3), ("car", 3)], "word string, count bigint")
    words = column(spark, ["seminer", "socail", "sociat", "cap", "xy", "qqqqqqq", "social", None, "semnar"])
    got = {r.word: (r.replacement, r.distance) for r in S.corrections(words, known).collect()}
    assert got == {"seminer": ("seminar", 1), "socail": ("social", 2), "sociat": ("social", 1), "cap": ("car", 1), "semnar": ("seminar", 1)}
    answers = spark.createDataFrame([(1, "I say Seminer!"), (2, None), (3, "a socail one"), (4, "")], "id int, answer string")
    fixed = S.replace_words(answers, "id", "answer", S.corrections(words, known), "fixed")
    found = {r.id: r["class"] for r in fixed.select("id", find_first("fixed", ["Seminar", "Social"]).alias("class")).collect()}
    assert found == {1: "Seminar", 2: "None", 3: "Social", 4: "None"}


def test_abbreviations_equal_plain_python(spark):
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{DATA / 'sf0.001' / 'documents.parquet'}'").fetchall()]
    texts += ["We met Dr. Smith and Dr. Jones. Then e.g. dr. Who came."] * 40 + [None, ""]
    counts, dotted = Counter(), Counter()
    for t in texts:
        for w in re.findall(r"[^\W\d_]+(?:\.[^\W\d_]+)*\.?", (t or "").lower()):
            counts[w.rstrip(".")] += 1
            dotted[w.rstrip(".")] += w.endswith(".")
    p = sum(dotted.values()) / sum(counts.values())
    like = lambda p, k, n: k * math.log(p) + (n - k) * math.log(1 - p)
    want = {}
    for w, k in dotted.items():
        if k:
            inner = w.count(".")
            size = len(w) - inner
            ratio = -2 * (like(p, k, counts[w]) - like(0.99, k, counts[w]))
            want[w] = ratio * math.exp(-size) * (inner + 1) * (1 / size) ** (counts[w] - k)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.type: r.score for r in A.abbreviation_scores(df, "text").collect()}
    assert got.keys() == want.keys() and all(abs(got[w] - want[w]) <= 1e-6 * max(1, abs(want[w])) for w in want)
    learnt = A.learn_abbreviations(df, "text")
    assert learnt == sorted(w for w, s in want.items() if s >= 0.3) and {"dr", "e.g"} <= set(learnt)


def test_sentences_with_abbreviations(spark):
    cases = {
        "Dr. Smith came. He sat.": ["Dr. Smith came.", "He sat."],
        "See e.g.  this one! Dr. Who? dr.": ["See e.g.  this one!", "Dr. Who?", "dr."],
        "  ": [], "": [], "Dr.": ["Dr."], "A.\nDr.\nB. C.": ["A.", "Dr.\nB.", "C."],
    }
    df = spark.createDataFrame([(t,) for t in [*cases, None]], "text string")
    got = {r.text: r.s for r in df.select("text", A.sentences("text", ["dr", "e.g"]).alias("s")).collect()}
    assert got == {**cases, None: None}
    same = df.select((A.sentences("text", []) == plain_sentences("text")).alias("s"))
    assert {r.s for r in same.collect()} <= {True, None}
    one = spark.createDataFrame([("Dr. Smith came. He sat.", "a, b")], "message string, label string")
    parted = R.split_multilabel(one, "label", cut=lambda c: A.sentences(c, ["dr"])).collect()
    assert [(r.message, r.label) for r in parted] == [("Dr. Smith came.", "a"), ("He sat.", "b")]


def test_correction_table_equals_the_list(spark):
    rng = random.Random(9)
    text = lambda: " ".join(rng.choice(["the", "an", "a", "then"]) for _ in range(rng.randrange(4)))
    data = [(rng.randrange(40), text() if rng.random() > 0.1 else None, "raw", {"k": "v"}) for _ in range(200)]
    df = spark.createDataFrame(data, "at int, text string, label string, m map<string, string>")
    prefixes = ["the an", "the", "an", "a the", "zz", "then"]
    fixes = [(p, i, f"new {p} {i}", f"L{i}") for p in prefixes for i in range(1 + len(p) % 2)]
    table = spark.createDataFrame([(p, prefixes.index(p), i, t, lab) for p, i, t, lab in fixes], "prefix string, place int, seq int, text string, label string")
    rows = lambda d: sorted((r.at, str(r.text), r.label, r.part_no) for r in d.collect())
    plain = df.drop("m")
    want = rows(R.apply_corrections(plain, fixes, "text", "label", ["at"]))
    assert rows(R.apply_correction_table(plain, table, "text", "label", ["at"])) == want
    assert len(rows(R.apply_correction_table(df, table, "text", "label", ["at"]))) == len(want)
    assert rows(R.apply_correction_table(df, table.limit(0), "text", "label", ["at"])) == sorted((a, str(t), lab, 0) for a, t, lab, _ in data)
    many = spark.range(100_000).select(F.concat(F.lit("p"), "id").alias("prefix"), F.lit(0).alias("place"), F.lit(0).alias("seq"), F.lit("t").alias("text"), F.lit("l").alias("label"))
    assert R.apply_correction_table(df, many, "text", "label", ["at"]).count() == len(data)


def test_rows_with_maps(spark):
    df = spark.createDataFrame([(i, {"a": str(i)}) for i in range(6)], "at int, m map<string, string>")
    assert sorted(r.at for r in R.drop_tail(df, 2, ["at"]).collect()) == [0, 1, 2, 3]


def plain_stem(word):
    """The cascade one word at a time."""
    if not re.fullmatch("[a-z]{3,}", word):
        return word

    def vowel(w, i):
        return w[i] in "aeiou" or (w[i] == "y" and i > 0 and w[i - 1] not in "aeiou")

    def kinds(w):
        # a y after a consonant is a vowel, by letters alone
        return "".join("V" if vowel(w, i) else "C" for i in range(len(w)))

    def m(w):
        return len(re.findall("V+C", kinds(w)))

    has = lambda w: "V" in kinds(w)

    def short(w):
        return len(w) > 2 and kinds(w)[-3:-1] == "CV" and w[-3] not in "aeiou" and w[-1] not in "aeiouwxy"

    def rules(w, table, ok):
        for suffix, new in sorted(table, key=lambda r: -len(r[0])):
            if w.endswith(suffix):
                s = w[: len(w) - len(suffix)]
                return s + new if ok(s, suffix) else w
        return w

    w = rules(word, ST.PLURALS, lambda s, x: True)
    fix = False
    if w.endswith("eed"):
        w = w[:-1] if m(w[:-3]) > 0 else w
    elif w.endswith("ed") and has(w[:-2]):
        w, fix = w[:-2], True
    elif w.endswith("ing") and has(w[:-3]):
        w, fix = w[:-3], True
    if fix:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif re.search(r"([^aeioulsz])\1$", w):
            w = w[:-1]
        elif m(w) == 1 and short(w):
            w += "e"
    if w.endswith("y") and has(w[:-1]):
        w = w[:-1] + "i"
    w = rules(w, ST.DOUBLE, lambda s, x: m(s) > 0)
    w = rules(w, ST.SINGLE, lambda s, x: m(s) > 0)
    w = rules(w, [(x, "") for x in ST.LAST], lambda s, x: m(s) > 1 and (x != "ion" or s[-1:] in ("s", "t")))
    if w.endswith("e") and (m(w[:-1]) > 1 or (m(w[:-1]) == 1 and not short(w[:-1]))):
        w = w[:-1]
    if w.endswith("ll") and m(w[:-1]) > 1:
        w = w[:-1]
    return w


def test_stems_equal_plain_python(spark):
    texts = [r[0] or "" for r in duckdb.sql(f"SELECT text FROM '{DATA / 'sf0.001' / 'documents.parquet'}'").fetchall()]
    words = {w for t in texts for w in re.findall("[a-z]+", t.lower())}
    known = "caresses ponies ties cats feed agreed plastered motoring sing conflated hopping falling hissing filing happy sky relational rational digitizer operator feudalism decisiveness formaliti triplicate formative electrical hopeful goodness revival allowance inference airliner adjustable replacement adoption communism effective probate rate cease controll roll yes yyy saying discussions dialogic deliberately".split()
    words |= set(known) | {"Étage", "", "ab", "x1y"}
    got = {r.word: r.stem for r in ST.stems(column(spark, [*words, None])).collect()}
    want = {w: plain_stem(w) for w in words}
    assert got == want and len(words) > 2_000
    assert [got[w] for w in ("caresses", "ponies", "motoring", "hopping", "relational", "discussions", "adjustable", "happy")] == ["caress", "poni", "motor", "hop", "relat", "discuss", "adjust", "happi"]
    counts = ST.stemmed_counts(spark.createDataFrame([("He discussed discussions.",), ("Discuss, discuss!",), (None,)], "text string"), "text")
    assert {tuple(r) for r in counts.collect()} == {("he", 1, 1), ("discuss", 3, 4)}


def test_pieces_equal_greedy_matching(spark):
    rng = random.Random(7)
    pieces = {"un", "##aff", "##able", "a", "##b", "##a", "b", "ab", "##bab", "字", "un##", "x" * 30, "c" * 20}
    words = {"unaffable", "unaffablex", "字", "", "c" * 20, "c" * 21, "x" * 30} | {"".join(rng.choice("abu") for _ in range(rng.randrange(1, 9))) for _ in range(200)}

    def cut(word):
        at, out = 0, []
        while at < len(word):
            fits = [n for n in range(min(20, len(word) - at), 0, -1) if ("##" if at else "") + word[at : at + n] in pieces]
            if not fits:
                return ["[UNK]"], False
            out.append(("##" if at else "") + word[at : at + fits[0]])
            at += fits[0]
        return out, True

    table = spark.createDataFrame([(p,) for p in [*pieces, None, "a"]], "piece string")
    got = {r.word: (r.pieces, r.known) for r in WP.pieces_of(column(spark, [*words, None, "ab"]), table).collect()}
    assert got == {w: cut(w) for w in words if w}
    df = spark.createDataFrame([(1, "ab AB zz"), (2, None), (3, ""), (4, "unaffable")], "id int, text string")
    assert {tuple(r) for r in WP.piece_lengths(df, "id", "text", table).collect()} == {(1, 3), (2, 0), (3, 0), (4, 3)}


def test_every_document_word_has_pieces(spark):
    docs = spark.read.parquet(str(DATA / "sf0.001" / "documents.parquet"))
    pieces = {r[0] for r in WP.common_pieces(docs, "text").collect()}
    words = {r[0] for r in docs.select(F.explode(tokens(F.lower("text")))).collect()}
    table = spark.createDataFrame([(p,) for p in pieces], "piece string")
    got = {r.word: r.pieces for r in WP.pieces_of(column(spark, words), table).collect()}
    for w in words:
        at, out = 0, []
        while at < len(w):
            n = next(n for n in range(min(20, len(w) - at), 0, -1) if ("##" if at else "") + w[at : at + n] in pieces)
            out.append(("##" if at else "") + w[at : at + n])
            at += n
        assert got[w] == out
