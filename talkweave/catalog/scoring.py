"""M, N and O: model surface, output repair, votes, evaluation, set distance."""

from pyspark.sql import functions as F

from ..functions.labels import allow_list
from ..functions.labels import argmax_label as argmax
from ..functions.labels import find_first as first_named
from ..functions.labels import parse_delimited as delimited
from ..operators import evaluate as E
from ..operators import rater_weights as W
from ..operators import scoring as M
from ..operators import shift as D
from ..operators import transport as T
from ..operators.joins import join_on_text
from .derive import KINDS, PREDS, RUNS_SQL, preds, runs, sql_list
from .registry import query


def mark_scorer():
    """A rule in place of a model: names a class by the marks a text holds."""

    def rule(texts):
        ask = texts.str.contains("?", regex=False)
        rush = texts.str.contains("!", regex=False)
        plain = texts.map(lambda _: "I would say Statement.")
        return plain.mask(rush, "Class: Exclamation").mask(ask, "Class: Question, not Statement")

    return rule


RULE = """CASE WHEN contains(text, '?') THEN 'Class: Question, not Statement'
               WHEN contains(text, '!') THEN 'Class: Exclamation' ELSE 'I would say Statement.' END"""


@query("score", f"SELECT doc_id, {RULE} AS response FROM documents")
def score(t):
    return M.score(t.documents, "text", mark_scorer).select("doc_id", "response")


def length_scorer():
    import pandas as pd

    def rule(texts):
        n = texts.str.len()
        return pd.Series([[float(x % 7), float(x % 5), float(x % 3)] for x in n], index=texts.index)

    return rule


@query(
    "argmax_label",
    """WITH s AS (SELECT doc_id, length(text) % 7 AS a, length(text) % 5 AS b, length(text) % 3 AS c FROM documents)
       SELECT doc_id, CASE WHEN a >= b AND a >= c THEN 'zeta' WHEN b >= c THEN 'beta' ELSE 'alpha' END AS label FROM s""",
)
def argmax_label(t):
    scored = M.score(t.documents, "text", length_scorer, "array<double>", "scores")
    return scored.select("doc_id", argmax("scores", ["zeta", "beta", "alpha"]).alias("label"))


NAMED = ["the", "of", "le", "der", "en", "que"]


@query(
    "find_first",
    f"""WITH c AS (SELECT doc_id, unnest({sql_list(NAMED + ['None'])}) AS name,
                          unnest(range({len(NAMED) + 1})) AS rank, lower(text) AS text FROM documents),
             h AS (SELECT doc_id, name, rank, strpos(text, lower(name)) AS pos FROM c WHERE strpos(text, lower(name)) > 0)
        SELECT d.doc_id, coalesce(upper(h.name[1]) || h.name[2:], 'None') AS label FROM documents d LEFT JOIN h ON d.doc_id = h.doc_id
        QUALIFY row_number() OVER (PARTITION BY d.doc_id ORDER BY pos, rank) = 1""",
)
def find_first(t):
    return t.documents.select("doc_id", first_named("text", [n.title() for n in NAMED]).alias("label"))


@query(
    "find_first_whole_word",
    rf"""SELECT doc_id, coalesce(list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+'),
                lambda w: list_contains({sql_list(NAMED)}, w))[1], 'None') AS label FROM documents""",
)
def find_first_whole_word(t):
    label = first_named("text", NAMED, whole_word=True)
    return t.documents.select("doc_id", label.alias("label"))


_REPLY = """CASE event_id % 5 WHEN 0 THEN props || ' // ' || event_type || ' '
    WHEN 1 THEN 'either view or click, ' || props WHEN 2 THEN props || ' // nonsense'
    WHEN 3 THEN 'perhaps ' || event_type ELSE props END"""


@query(
    "parse_delimited",
    f"""WITH r AS (SELECT event_id, {_REPLY} AS r FROM events),
        p AS (SELECT event_id, CASE WHEN contains(r, '//') THEN trim(string_split(r, '//')[2])
                ELSE coalesce(list_filter({sql_list(KINDS)}, lambda k: contains(r, k))[-1], 'Not Found') END AS label FROM r)
        SELECT event_id, label, CASE WHEN list_contains({sql_list(KINDS)}, label) THEN label ELSE 'None' END AS kept FROM p""",
)
def parse_delimited(t):
    i, kind, props = F.col("event_id") % 5, F.col("event_type"), F.col("props")
    reply = (
        F.when(i == 0, F.concat(props, F.lit(" // "), kind, F.lit(" ")))
        .when(i == 1, F.concat(F.lit("either view or click, "), props))
        .when(i == 2, F.concat(props, F.lit(" // nonsense")))
        .when(i == 3, F.concat(F.lit("perhaps "), kind))
        .otherwise(props)
    )
    done = t.events.select("event_id", delimited(reply, KINDS).alias("label"))
    return done.withColumn("kept", allow_list("label", KINDS))


def _sql_vote(weight):
    return f"""WITH {PREDS}, w AS (
      SELECT event_id, label, sum({weight}) AS w FROM preds GROUP BY 1, 2)
    SELECT event_id, label FROM w
    QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY label IS NULL, w DESC, label) = 1"""


@query("vote", _sql_vote("1"))
def vote(t):
    return M.vote(preds(t), "event_id")


@query("vote_weighted", _sql_vote("CASE run_id WHEN 'llama' THEN 3 WHEN 'bert' THEN 2 ELSE 1 END"))
def vote_weighted(t):
    return M.vote(preds(t), "event_id", weights={"llama": 3, "bert": 2, "mistral": 1})


_PER_CLASS = f"""{RUNS_SQL},
  pairs AS (SELECT coalesce(label, 'None') AS y, coalesce(llama, 'None') AS p FROM runs),
  classes AS (SELECT y AS class FROM pairs UNION SELECT p FROM pairs),
  per AS (SELECT class, (SELECT count(*) FROM pairs WHERE y = class) AS support,
                 (SELECT count(*) FROM pairs WHERE p = class) AS guessed,
                 (SELECT count(*) FROM pairs WHERE p = class AND y = class) AS hit FROM classes),
  m AS (SELECT class, support, hit, CASE WHEN guessed = 0 THEN 0 ELSE hit / guessed END AS pr,
               CASE WHEN support = 0 THEN 0 ELSE hit / support END AS re,
               CASE WHEN guessed + support = 0 THEN 0 ELSE 2 * hit / (guessed + support) END AS f1 FROM per)"""


@query(
    "summary_metrics",
    f"""WITH {_PER_CLASS} SELECT round(sum(hit) / sum(support), 6) AS accuracy,
        round(sum(pr * support) / sum(support), 6) AS precision,
        round(sum(re * support) / sum(support), 6) AS recall,
        round(sum(f1 * support) / sum(support), 6) AS f1 FROM m""",
)
def summary_metrics(t):
    done = E.summary_metrics(runs(t), "label", "llama")
    return done.select(*[F.round(c, 6).alias(c) for c in done.columns])


@query(
    "classification_report",
    f"""WITH {_PER_CLASS}
        SELECT class, 'class' AS kind, round(pr, 6) AS precision, round(re, 6) AS recall,
               round(f1, 6) AS f1, support FROM m
        UNION ALL SELECT 'accuracy', 'summary', NULL, NULL, round(sum(hit) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m
        UNION ALL SELECT 'macro avg', 'summary', round(avg(pr), 6), round(avg(re), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM m
        UNION ALL SELECT 'weighted avg', 'summary', round(sum(pr * support) / sum(support), 6),
               round(sum(re * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m""",
)
def classification_report(t):
    done = E.classification_report(runs(t), "label", "llama")
    return done.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


_NULLS = """SELECT {scope} AS scope, count(*) AS rows,
    round(avg(CAST(coalesce(label, 'NaN') IS NOT DISTINCT FROM p AS INTEGER)), 6) AS accuracy FROM x"""


@query(
    "accuracy_by_null",
    f"""WITH {RUNS_SQL}, x AS (SELECT label, CASE WHEN event_id % 2 = 0 THEN coalesce(bert, 'NaN') ELSE 'NaN' END AS p FROM runs)
        {_NULLS.format(scope="'all'")} UNION ALL
        {_NULLS.format(scope="'labelled'")} WHERE label IS NOT NULL UNION ALL
        {_NULLS.format(scope="'unlabelled'")} WHERE label IS NULL""",
)
def accuracy_by_null(t):
    p = F.when(F.col("event_id") % 2 == 0, F.coalesce("bert", F.lit("NaN"))).otherwise("NaN")
    done = E.accuracy_by_null(runs(t).withColumn("p", p), "label", "p")
    return done.withColumn("accuracy", F.round("accuracy", 6))


@query(
    "accuracy_on_text_join",
    """WITH a AS (SELECT text, lang FROM documents), x AS (
          SELECT a.lang AS p, CASE WHEN b.source != 'src3' THEN b.lang END AS label FROM a JOIN documents b ON a.text = b.text)
       SELECT 'all' AS scope, count(*) AS rows, round(avg(CAST(coalesce(label, 'NaN') = p AS INTEGER)), 6) AS accuracy FROM x
       UNION ALL SELECT 'labelled', count(*), round(avg(CAST(label = p AS INTEGER)), 6) FROM x WHERE label IS NOT NULL
       UNION ALL SELECT 'unlabelled', count(*), 0.0 FROM x WHERE label IS NULL""",
)
def accuracy_on_text_join(t):
    """Responses joined back to labels by text, copies counted with their number."""
    label = F.when(F.col("source") != "src3", F.col("lang"))
    right = t.documents.select("text", label.alias("label"))
    joined = join_on_text(t.documents.withColumn("p", F.col("lang")), right, "text", ["p"], ["label"])
    done = E.accuracy_by_null(joined, "label", "p", weight="pairs")
    return done.withColumn("accuracy", F.round("accuracy", 6))


def _halves(t):
    v = t.embeddings
    return v.filter(F.col("vec_id") % 2 == 0), v.filter(F.col("vec_id") % 2 == 1)


_MEANS = """means AS (
    SELECT side, label, dim, avg(x) AS x FROM (
      SELECT vec_id % 2 AS side, CAST(label AS VARCHAR) AS label, unnest(range(64)) AS dim,
             unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings) GROUP BY 1, 2, 3)"""


@query(
    "label_mean_distances",
    f"""WITH {_MEANS}
        SELECT a.label AS label_a, b.label AS label_b, round(sqrt(sum((a.x - b.x) * (a.x - b.x))), 6) AS distance
        FROM means a JOIN means b ON a.dim = b.dim AND a.side = 0 AND b.side = 1 GROUP BY 1, 2""",
)
def label_mean_distances(t):
    done = D.label_mean_distances(*_halves(t), "label", "embedding")
    return done.withColumn("distance", F.round("distance", 6))


_PAIRS = """(SELECT avg(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])))
    FROM {a} a, {b} b)"""
_ENERGY = f"""e AS (SELECT * FROM embeddings WHERE vec_id % 2 = 0 ORDER BY md5('42|' || vec_id) LIMIT 10000),
  o AS (SELECT * FROM embeddings WHERE vec_id % 2 = 1 ORDER BY md5('42|' || vec_id) LIMIT 10000),
  energy AS (SELECT 2 * {_PAIRS.format(a='e', b='o')} - {_PAIRS.format(a='e', b='e')}
                    - {_PAIRS.format(a='o', b='o')} AS distance)"""


@query("sampled_energy_distance", f"WITH {_ENERGY} SELECT round(distance, 6) AS distance FROM energy")
def sampled_energy_distance(t):
    done = D.sampled_energy_distance(*_halves(t), "vec_id", "embedding")
    return done.withColumn("distance", F.round("distance", 6))


_DIRECTIONS = 16
_SLICED = f"""side AS (SELECT vec_id % 2 AS side, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
  waves AS (SELECT d, [sin((i + 1) * (12.9898 * (d + 1))) for i in range(64)] AS u FROM range({_DIRECTIONS}) AS r(d)),
  along AS (SELECT d, side, list_dot_product(v, u) / sqrt(list_dot_product(u, u)) AS x FROM side, waves),
  steps AS (SELECT d, x, sum((side = 0)::INT) OVER w / sum((side = 0)::INT) OVER (PARTITION BY d) AS f,
                   sum((side = 1)::INT) OVER w / sum((side = 1)::INT) OVER (PARTITION BY d) AS g,
                   lead(x) OVER (PARTITION BY d ORDER BY x) AS y
            FROM along WINDOW w AS (PARTITION BY d ORDER BY x)),
  energy AS (SELECT 2 * sum((f - g) * (f - g) * (y - x)) / {_DIRECTIONS} AS distance FROM steps)"""


@query("energy_distance", f"WITH {_SLICED} SELECT round(distance, 6) AS distance FROM energy")
def energy_distance(t):
    return D.energy_distance(*_halves(t), "embedding").withColumn("distance", F.round("distance", 6))


@query(
    "compare_sets",
    f"""WITH {_MEANS}, {_SLICED}
        SELECT 'label' AS target, a.label AS label_a, b.label AS label_b,
               round(sqrt(sum((a.x - b.x) * (a.x - b.x))), 6) AS distance
        FROM means a JOIN means b ON a.dim = b.dim AND a.side = 0 AND b.side = 1 GROUP BY 1, 2, 3
        UNION ALL SELECT NULL, NULL, NULL, round(distance, 6) FROM energy""",
)
def compare_sets(t):
    a, b = _halves(t)
    done = D.compare_sets(a.withColumn("only_here", F.lit(1)), b, ["label"], "embedding")
    return done.withColumn("distance", F.round("distance", 6))


@query("label_transport")
def label_transport(t):
    """What each kind of vector of one half gives to each of the other, and the cost of the whole plan."""
    moved = T.label_transport(*_halves(t), "label", "embedding")
    return moved.select("*", T.transport_distance(moved).scalar().alias("distance"))


@query("learned_votes")
def learned_votes(t):
    """Each event's class by votes weighted with what the runs seem to get right, and how likely it is."""
    found = preds(t)
    model = W.rater_model(found, "event_id", "run_id", "label")
    return W.weighted_vote(found, model, "event_id", "run_id", "label").withColumn("share", F.round("share", 6))
