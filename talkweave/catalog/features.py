"""K: features and tree models."""

from pyspark.sql import functions as F

from ..functions.labels import one_hot as hot
from ..functions.stopwords import ENGLISH
from ..functions.text import clean_tokens as clean
from ..functions.text import normalise_text as normalise
from ..operators import boosting as B
from ..operators import features as K
from ..operators.evaluate import classification_report
from ..operators.splits import merge_splits, stratified_split
from ..session import written
from .derive import KINDS, MESSAGES, messages, sql_list, sql_tokens
from .explore import STOP, WORDS
from .registry import query

DIM = 64


@query(
    "clean_tokens",
    f"""SELECT doc_id, array_to_string(list_filter({sql_tokens('lower(text)')},
                 lambda w: w NOT IN {STOP}), ' ') AS text FROM documents""",
)
def clean_tokens(t):
    return t.documents.select("doc_id", clean("text", ENGLISH).alias("text"))


@query(
    "normalise_text",
    rf"""SELECT doc_id, array_to_string(list_filter({sql_tokens('lower(text)')},
                 lambda w: regexp_full_match(w, '\p{{L}}+')), ' ') AS text FROM documents""",
)
def normalise_text(t):
    return t.documents.select("doc_id", normalise("text").alias("text"))


def _vectors(t):
    """A vector for the words whose hash names one; about one word in eight at sf0.01."""
    words = t.documents.select(F.explode(F.array_distinct(K.clean_token_array("text"))).alias("word")).distinct()
    number = F.conv(F.substring(F.md5("word"), 1, 3), 16, 10).cast("bigint")
    vectors = t.embeddings.select(F.col("vec_id").alias("v"), F.col("embedding").alias("vector"))
    return words.withColumn("v", number).join(vectors, "v").select("word", "vector")


_VECTORS = f"""{WORDS}, counted AS (SELECT doc_id, term, count(*) AS n FROM words GROUP BY 1, 2),
  vocab AS (SELECT term, embedding AS e FROM (SELECT DISTINCT term FROM words) w
            JOIN embeddings ON vec_id = CAST('0x' || substr(md5(term), 1, 3) AS BIGINT))"""
_SUMS = ", ".join(f"coalesce(sum(n * CAST(e[{i + 1}] AS DOUBLE)), 0) AS d{i}" for i in range(DIM))
_TOTALS = " + ".join(f"d{i} * d{i}" for i in range(DIM))


@query(
    "embedding_sum",
    f"""WITH {_VECTORS}, s AS (
          SELECT d.doc_id, CAST(coalesce(sum(n) FILTER (WHERE e IS NOT NULL), 0) AS BIGINT) AS known_words, {_SUMS}
          FROM documents d LEFT JOIN (SELECT doc_id, n, e FROM counted JOIN vocab USING (term)) c
            ON d.doc_id = c.doc_id GROUP BY 1)
        SELECT doc_id, known_words, round(d0, 4) + 0.0 AS first, round(d63, 4) + 0.0 AS last,
               round(sqrt({_TOTALS}), 4) AS norm FROM s""",
)
def embedding_sum(t):
    # the vocabulary as a stored table, as a job would have it: its size is known before the join is planned
    vocabulary = written(_vectors(t), "vocabulary")
    done = K.embedding_sum(t.documents.select("doc_id", "text"), vocabulary, "text", "doc_id", DIM)
    squares = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    return done.select(
        "doc_id",
        "known_words",
        (F.round(F.get("embedding", F.lit(0)), 4) + 0.0).alias("first"),
        (F.round(F.get("embedding", F.lit(DIM - 1)), 4) + 0.0).alias("last"),
        F.round(F.sqrt(squares), 4).alias("norm"),
    )


@query(
    "unknown_words",
    f"""WITH {_VECTORS} SELECT term AS word, count(*) AS "count" FROM words
        WHERE term NOT IN (SELECT term FROM vocab) GROUP BY 1""",
)
def unknown_words(t):
    return K.unknown_words(t.documents, _vectors(t), "text", "doc_id")


@query(
    "label_index",
    f"""WITH {MESSAGES}
        SELECT conv_id, turn, CAST(dense_rank() OVER (ORDER BY coalesce(uptake, 'None')) - 1 AS INTEGER) AS label_id
        FROM messages""",
)
def label_index(t):
    return K.with_label_index(messages(t).select("conv_id", "turn", "uptake"), "uptake").drop("uptake")


@query(
    "one_hot",
    f"""SELECT event_id, array_to_string(list_transform({sql_list(KINDS)},
               lambda k: CAST(CAST(k = event_type AS INTEGER) AS VARCHAR)), '') AS bits FROM events""",
)
def one_hot(t):
    bits = F.array_join(F.transform(hot("event_type", KINDS), lambda b: b.cast("string")), "")
    return t.events.select("event_id", bits.alias("bits"))


@query(
    "class_weights",
    f"""WITH {MESSAGES}, c AS (SELECT coalesce(uptake, 'None') AS label, count(*) AS "count" FROM messages GROUP BY 1)
        SELECT label, "count", round((SELECT sum("count") FROM c) / ((SELECT count(*) FROM c) * "count"), 6) AS weight
        FROM c""",
)
def class_weights(t):
    return K.class_weights(messages(t), "uptake").withColumn("weight", F.round("weight", 6))


def _parity(t):
    """Ten kinds of vectors folded to three classes."""
    return t.embeddings.select("vec_id", "embedding", (F.col("label") % 3).alias("label"))


_SPLIT = """k AS (SELECT vec_id, CAST(label % 3 AS VARCHAR) AS label,
         row_number() OVER (PARTITION BY label % 3 ORDER BY md5('42|' || vec_id), vec_id) AS pos,
         count(*) OVER (PARTITION BY label % 3) AS n FROM embeddings),
  test AS (SELECT vec_id, label FROM k WHERE pos > floor(n * 0.8::DOUBLE + 0.5))"""


def _fitted(t):
    """Boosted trees on vectors, time parts, page and response number, fitted on train and validation rows."""
    at = F.timestamp_seconds(F.col("vec_id") * 3600)
    df = _parity(t).withColumns(
        {"hour": F.hour(at), "day": F.dayofmonth(at), "page": F.col("vec_id") % 7, "response_number": F.col("vec_id") % 3}
    )
    rows = merge_splits(stratified_split(df, "vec_id", "label"))
    extra = ["hour", "day", "page", "response_number"]
    model, names = K.boosted_classifier(rows.filter("split = 'train'"), "label", "embedding", extra, rounds=3, depth=3)
    return rows.filter("split = 'test'"), extra, model, names


@query("boosted_classifier", f"WITH {_SPLIT} SELECT vec_id, label, true AS known FROM test")
def boosted_classifier(t):
    """Test rows, each with one of the classes of the training rows as its prediction."""
    test, extra, model, names = _fitted(t)
    done = K.predict(model, names, test, "label", "embedding", extra)
    return done.select("vec_id", F.col("label").cast("string").alias("label"), F.col("predicted").isin(*names).alias("known"))


@query("boosted_report", f"WITH {_SPLIT} SELECT label AS class, count(*) AS support, true AS better_than_chance FROM test GROUP BY 1")
def boosted_report(t):
    """Support of each class in the test report, and whether the model beats a guess of one class in three."""
    test, extra, model, names = _fitted(t)
    lines = classification_report(K.predict(model, names, test, "label", "embedding", extra), "label", "predicted")
    accuracy = lines.filter("class = 'accuracy'").agg(F.max("f1")).scalar()
    return lines.filter("kind = 'class' AND support > 0").select("class", "support", (accuracy > 0.34).alias("better_than_chance"))


@query("feature_importance", "SELECT 10 AS features, true AS named, true AS in_order, true AS shares")
def feature_importance(t):
    """What must hold of the ten most used features of the boosted model."""
    test, extra, model, _ = _fitted(t)
    names = [f"embedding_{i}" for i in range(DIM)] + extra
    top = K.feature_importance(model, t.spark, names=names)
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("importance")).alias("i"), F.col("feature").alias("f"))))
    return top.agg(
        F.count("*").cast("int").alias("features"),
        F.bool_and(F.col("feature").isin(*names)).alias("named"),
        (F.size(ranked) == F.count_distinct("feature")).alias("in_order"),
        ((F.sum("importance") <= 1 + 1e-9) & (F.min("importance") >= 0)).alias("shares"),
    )


_CUTS = {
    "l_quantity": [float(x) for x in range(5, 50, 5)],
    "l_extendedprice": [10_000.0 * x for x in range(1, 10)],
    "l_discount": [x / 100 - 0.005 for x in range(1, 11)],
    "l_tax": [x / 100 - 0.005 for x in range(1, 9)],
}


@query(
    "boosted_root_splits",
    f"""WITH cuts(feature, place, cuts) AS (VALUES {', '.join(f"('{c}', {i}, {v})" for i, (c, v) in enumerate(_CUTS.items()))}),
        c AS (SELECT feature, place, i - 1 AS bin, cuts[i] AS cut FROM (SELECT *, unnest(range(1, len(cuts) + 1)) AS i FROM cuts)),
        x AS (UNPIVOT (SELECT l_returnflag AS y, {', '.join(f'{c}::DOUBLE AS {c}' for c in _CUTS)} FROM lineitem) ON {', '.join(_CUTS)} INTO NAME feature VALUE v),
        k AS (SELECT DISTINCT l_returnflag AS class FROM lineitem),
        n AS (SELECT class, 1.0::DOUBLE / (SELECT count(*) FROM k) AS p FROM k),
        s AS (SELECT class, feature, place, bin, p * (1 - p) AS w,
                     sum((v < cut)::INT * (p - (y = class)::INT)) AS gl, sum((v < cut)::INT) * any_value(p * (1 - p)) AS hl,
                     sum((v >= cut)::INT * (p - (y = class)::INT)) AS gr, sum((v >= cut)::INT) * any_value(p * (1 - p)) AS hr
              FROM x JOIN c USING (feature), n GROUP BY ALL)
        SELECT class, feature, CAST(bin AS INTEGER) AS bin,
               round((gl * gl / (hl + 1) + gr * gr / (hr + 1) - (gl + gr) * (gl + gr) / (hl + hr + 1)) / 2, 6) AS gain
        FROM s WHERE hl >= 1 AND hr >= 1
        QUALIFY row_number() OVER (PARTITION BY class ORDER BY round((gl * gl / (hl + 1) + gr * gr / (hr + 1) - (gl + gr) * (gl + gr) / (hl + hr + 1)) / 2, 9) DESC, place, bin) = 1""",
)
def boosted_root_splits(t):
    """The first split of each class's first tree over all line items."""
    model = B.boost(t.lineitem, "l_returnflag", None, list(_CUTS), rounds=1, depth=1, cuts=list(_CUTS.values()))
    return B.splits_of(model, t.spark).select("class", "feature", "bin", F.round("gain", 6).alias("gain"))


@query("softmax_trees")
def softmax_trees(t):
    """Test rows with the class that trees boosted on the other rows of the vectors give them."""
    rows = merge_splits(stratified_split(_parity(t), "vec_id", "label"))
    model = B.boost(rows.filter("split = 'train'"), "label", "embedding", rounds=3, depth=2)
    done = B.predict_boosted(model, rows.filter("split = 'test'"), "embedding")
    return done.select("vec_id", F.col("label").cast("string").alias("label"), "predicted")
