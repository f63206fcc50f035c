"""G and H: rater agreement and splits."""

from pyspark.sql import functions as F

from ..operators import agreement as A
from ..operators import splits as S
from .derive import RATERS, raters
from .registry import query

NAMES = ["r1", "r2", "r3"]


@query(
    "row_mode",
    f"""WITH {RATERS}, votes AS (
          SELECT event_id, unnest([r1, r2, r3]) AS v FROM raters),
        n AS (SELECT event_id, v, count(*) AS n FROM votes WHERE v IS NOT NULL GROUP BY 1, 2)
        SELECT event_id, v AS label FROM n
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY n DESC, v) = 1""",
)
def row_mode(t):
    return A.majority_label(raters(t).drop("user_id", "ts"), NAMES, "label")


_PAIRS = "(VALUES ('r1', 'r2'), ('r1', 'r3'), ('r2', 'r3')) AS p(rater_a, rater_b)"


@query(
    "pairwise_kappa",
    f"""WITH {RATERS},
        long AS (SELECT event_id, unnest(['r1', 'r2', 'r3']) AS rater,
                        coalesce(unnest([r1, r2, r3]), 'nan') AS label FROM raters),
        pairs AS (SELECT a.rater AS rater_a, b.rater AS rater_b, a.label AS la, b.label AS lb
                 FROM long a JOIN long b ON a.event_id = b.event_id AND a.rater < b.rater),
        n AS (SELECT rater_a, rater_b, count(*) AS n, avg(CAST(la = lb AS INTEGER)) AS po FROM pairs GROUP BY 1, 2),
        ma AS (SELECT rater_a, rater_b, la AS l, count(*) AS c FROM pairs GROUP BY 1, 2, 3),
        mb AS (SELECT rater_a, rater_b, lb AS l, count(*) AS c FROM pairs GROUP BY 1, 2, 3),
        pe AS (SELECT n.rater_a, n.rater_b, sum(ma.c / n.n * (mb.c / n.n)) AS pe
               FROM n JOIN ma USING (rater_a, rater_b) JOIN mb USING (rater_a, rater_b, l) GROUP BY 1, 2)
        SELECT n.rater_a, n.rater_b, n.n, round(po, 6) AS observed, round(pe, 6) AS expected,
               round((po - pe) / (1 - pe), 6) AS kappa
        FROM n JOIN pe USING (rater_a, rater_b)""",
)
def pairwise_kappa(t):
    k = A.pairwise_kappa(raters(t), NAMES)
    return k.select("rater_a", "rater_b", "n", *[F.round(c, 6).alias(c) for c in ("observed", "expected", "kappa")])


@query(
    "rater_conflicts",
    f"""WITH {RATERS} SELECT r1 AS first_label, r2 AS second_label, count(*) AS "count" FROM raters
        WHERE (r1 IS NULL) != (r2 IS NULL) GROUP BY 1, 2""",
)
def rater_conflicts(t):
    return A.rater_conflicts(raters(t), "r1", "r2")


def _coded_documents(t):
    return t.documents.select("doc_id").join(
        t.labels.select("doc_id", F.col("quality").cast("string").alias("label")), "doc_id", "left"
    )


_CODED = """coded AS (SELECT d.doc_id, CAST(l.quality AS VARCHAR) AS label
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
_RANKED = (
    _CODED
    + """, ranked AS (SELECT doc_id, label,
       row_number() OVER (PARTITION BY coalesce(label, 'None') ORDER BY md5('42|' || doc_id), doc_id) AS pos,
       count(*) OVER (PARTITION BY coalesce(label, 'None')) AS n FROM coded)"""
)


def _sql_split(a, b):
    return f"""CASE WHEN pos <= floor(n * {a}::DOUBLE + 0.5) THEN 'train'
                    WHEN pos <= floor(n * {b}::DOUBLE + 0.5) THEN 'validation' ELSE 'test' END"""


@query("stratified_split", f"WITH {_RANKED} SELECT doc_id, label, {_sql_split('0.6', '0.8')} AS split FROM ranked")
def stratified_split(t):
    return S.stratified_split(_coded_documents(t), "doc_id", "label")


@query(
    "stratified_split_two_step",
    f"WITH {_RANKED} SELECT doc_id, label, {_sql_split('0.56', '0.8')} AS split FROM ranked",
)
def stratified_split_two_step(t):
    return S.stratified_split(_coded_documents(t), "doc_id", "label", S.TWO_STEP)


_RANDOM = """split AS (SELECT doc_id,
    CASE WHEN CAST('0x' || substr(md5('42|' || doc_id), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE < {edge}::DOUBLE
         THEN 'train' ELSE 'validation' END AS split FROM documents)"""


@query("random_split", f"WITH {_RANDOM.replace('{edge}', '0.8')} SELECT * FROM split")
def random_split(t):
    return S.random_split(t.documents.select("doc_id"), "doc_id")


@query(
    "merge_splits",
    f"""WITH {_RANKED} SELECT split, count(*) AS n FROM (
          SELECT CASE WHEN s = 'validation' THEN 'train' ELSE s END AS split
          FROM (SELECT {_sql_split('0.6', '0.8')} AS s FROM ranked)) GROUP BY 1""",
)
def merge_splits(t):
    merged = S.merge_splits(S.stratified_split(_coded_documents(t), "doc_id", "label"))
    return merged.groupBy("split").agg(F.count("*").alias("n"))


@query(
    "apply_index_split",
    f"""WITH {_RANDOM.replace('{edge}', '0.8')} SELECT d.doc_id, d.source, s.split
        FROM documents d JOIN split s ON d.doc_id = s.doc_id
        WHERE d.doc_id % 10 < 7""",
)
def apply_index_split(t):
    """The saved index names seven of ten documents."""
    index = S.random_split(t.documents.select("doc_id"), "doc_id").filter(F.col("doc_id") % 10 < 7)
    return S.apply_index_split(t.documents.select("doc_id", "source"), index, "doc_id")
