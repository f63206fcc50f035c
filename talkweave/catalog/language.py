"""Spelling, abbreviations and sentence boundaries learnt from the tables."""

from pyspark.sql import functions as F

from ..functions.text import length_bucket
from ..operators import abbreviations as A
from ..operators import spelling as S
from ..operators import stemming as ST
from ..operators import word_pieces as WP
from ..session import written
from .registry import query

_ASCII = "[a-z]+"
_WORDS = f"""said AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{_ASCII}')) AS word FROM conversations),
    known AS (SELECT word, count(*) AS count FROM (SELECT unnest(regexp_extract_all(lower(text), '{_ASCII}')) AS word FROM documents)
              GROUP BY 1 HAVING count(*) >= 20)"""


def _said(t):
    found = F.regexp_extract_all(F.lower("text"), F.lit(_ASCII), F.lit(0))
    words = t.conversations.select(F.explode(found).alias("word"))
    known = t.documents.select(F.explode(found).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return words, known.filter(F.col("count") >= 20)


@query(
    "near_words",
    f"""WITH {_WORDS} SELECT s.word AS "left", k.word AS "right", CAST(levenshtein(s.word, k.word) AS INTEGER) AS distance
        FROM said s JOIN known k ON abs(length(s.word) - length(k.word)) <= 2 WHERE levenshtein(s.word, k.word) <= 2""",
)
def near_words(t):
    """All pairs of a message's word and a common document word at an edit distance of up to two."""
    words, known = _said(t)
    return S.near_words(words, known)


@query(
    "spelling_corrections",
    f"""WITH {_WORDS},
        pairs AS (SELECT s.word, k.word AS replacement, count, levenshtein(s.word, k.word) AS distance
                  FROM said s JOIN known k ON abs(length(s.word) - length(k.word)) <= 2 WHERE s.word NOT IN (SELECT word FROM known))
        SELECT word, replacement, CAST(distance AS INTEGER) AS distance FROM pairs
        WHERE distance <= CASE WHEN length(word) <= 2 THEN 0 WHEN length(word) <= 4 THEN 1 ELSE 2 END
        QUALIFY row_number() OVER (PARTITION BY word ORDER BY distance, count DESC, replacement) = 1""",
)
def spelling_corrections(t):
    return S.corrections(*_said(t))


@query(
    "abbreviation_scores",
    r"""WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}]+(?:\.[\p{L}\p{M}]+)*\.?')) AS word FROM documents),
        c AS (SELECT rtrim(word, '.') AS type, count(*) AS n, count(*) FILTER (WHERE word LIKE '%.') AS dotted FROM w GROUP BY 1),
        p AS (SELECT sum(dotted) / sum(n) AS p FROM c),
        s AS (SELECT *, length(type) - length(replace(type, '.', '')) AS inside FROM c, p WHERE dotted > 0)
        SELECT type, n, dotted, round(-2 * (dotted * ln(p) + (n - dotted) * ln(1 - p) - dotted * ln(0.99) - (n - dotted) * ln(1 - 0.99))
               * exp(-(length(type) - inside)) * (inside + 1) * pow(1.0 / (length(type) - inside), n - dotted), 6) AS score FROM s""",
)
def abbreviation_scores(t):
    """How much each type of the documents behaves like an abbreviation."""
    return A.abbreviation_scores(t.documents, "text").withColumn("score", F.round("score", 6))


@query("learnt_sentences")
def learnt_sentences(t):
    """Sentences of all documents, cut with the abbreviations learnt from them."""
    known = A.learn_abbreviations(t.documents, "text")
    return t.documents.select("doc_id", F.posexplode(A.sentences("text", known)).alias("sentence_no", "sentence"))


@query("stemmed_counts")
def stemmed_counts(t):
    """Stems of all words of the documents, with how many words and occurrences each stands for."""
    return ST.stemmed_counts(t.documents, "text")


@query("piece_lengths")
def piece_lengths(t):
    """How many word pieces each document has, and its length bucket, by pieces common in the documents."""
    pieces = written(WP.common_pieces(t.documents, "text"), "pieces")
    return WP.piece_lengths(t.documents, "doc_id", "text", pieces).withColumn("bucket", length_bucket("n_pieces"))
