"""F: aggregates, histograms, terms, samples."""

from pyspark.sql import functions as F

from ..functions.labels import as_class
from ..functions.stopwords import ENGLISH
from ..functions.text import length_bucket as bucket
from ..functions.text import tokens
from ..operators import explore as X
from .derive import MESSAGES, messages, sql_text, sql_tokens
from .registry import query

STOP = "(" + ", ".join(sql_text(w) for w in ENGLISH) + ")"


@query(
    "value_counts",
    f'WITH {MESSAGES} SELECT uptake, count(*) AS "count" FROM messages GROUP BY 1',
)
def value_counts(t):
    return X.value_counts(messages(t), "uptake", dropna=False)


@query(
    "value_counts_dropna",
    f'WITH {MESSAGES} SELECT uptake, count(*) AS "count" FROM messages WHERE uptake IS NOT NULL GROUP BY 1',
)
def value_counts_dropna(t):
    return X.value_counts(messages(t), "uptake")


@query(
    "value_share",
    f"""WITH {MESSAGES} SELECT course, count(*) AS "count",
               round(count(*) / (SELECT count(*) FROM messages), 6) AS share FROM messages GROUP BY 1""",
)
def value_share(t):
    return X.value_share(messages(t), "course").withColumn("share", F.round("share", 6))


@query(
    "top_n_counts",
    """SELECT user_id, count(*) AS "count" FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30""",
)
def top_n_counts(t):
    return X.top_n_counts(t.events, "user_id")


for _name, _units, _sql in (
    ("date", ("date",), "CAST(ts AS DATE) AS date"),
    ("hour", ("hour",), "CAST(hour(ts) AS INTEGER) AS hour"),
    ("minute", ("hour", "minute"), "CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute"),
    (
        "month",
        ("year", "month", "day"),
        "CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day",
    ),
):
    query(
        f"counts_over_time_{_name}",
        f'SELECT {_sql}, count(*) AS "count" FROM events GROUP BY ALL',
    )(lambda t, units=_units: X.counts_over_time(t.events, "ts", units))


@query(
    "counts_by_category",
    f"""WITH {MESSAGES}
        SELECT "column", coalesce(v, 'None') AS value, count(*) AS "count" FROM (
          SELECT 'discussion_type' AS "column", discussion_type AS v FROM messages
          UNION ALL SELECT 'uptake', uptake FROM messages
          UNION ALL SELECT 'question', question FROM messages
          UNION ALL SELECT 'turn', CAST(turn AS VARCHAR) FROM messages) GROUP BY 1, 2""",
)
def counts_by_category(t):
    return X.counts_by_category(messages(t), ["discussion_type", "uptake", "question", "turn"])


@query(
    "length_histogram",
    """WITH x AS (SELECT CAST(length(text) AS DOUBLE) AS x FROM documents),
            r AS (SELECT min(x) AS lo, (max(x) - min(x)) / 50.0 AS w FROM x)
       SELECT CAST(least(floor((x - lo) / w), 49) AS BIGINT) AS bin, count(*) AS "count",
              min(x) AS min_x, max(x) AS max_x
       FROM x, r GROUP BY 1""",
)
def length_histogram(t):
    return X.length_histogram(t.documents, "text")


@query(
    "extreme_tokens",
    f"""WITH t AS (SELECT DISTINCT unnest({sql_tokens('text')}) AS t FROM documents)
        SELECT (SELECT t FROM t ORDER BY length(t) DESC, t LIMIT 1) AS longest,
               (SELECT t FROM t ORDER BY length(t), t LIMIT 1) AS shortest""",
)
def extreme_tokens(t):
    return X.extreme_tokens(t.documents, "text")


WORDS = f"words AS (SELECT doc_id, unnest({sql_tokens('lower(text)')}) AS term FROM documents)"


@query(
    "term_frequencies",
    rf"""WITH {WORDS} SELECT term, count(*) AS "count" FROM words
        WHERE term NOT IN {STOP} AND regexp_matches(term, '[\p{{L}}\p{{N}}]')
        GROUP BY 1""",
)
def term_frequencies(t):
    return X.term_frequencies(t.documents, "text", ENGLISH)


@query(
    "first_n_per_class",
    f"""WITH {MESSAGES}
        SELECT conv_id, turn, message, coalesce(uptake, 'NaN') AS uptake,
               CAST(row_number() OVER (PARTITION BY coalesce(uptake, 'NaN') ORDER BY conv_id, turn) AS INTEGER) AS rank
        FROM messages QUALIFY rank <= 5""",
)
def first_n_per_class(t):
    df = messages(t).select("conv_id", "turn", "message", "uptake")
    return X.first_n_per_class(df, "uptake", ["conv_id", "turn"], 5)


_TERMS = rf"""{WORDS}, kept AS (
    SELECT doc_id, term FROM words WHERE term NOT IN {STOP}
      AND regexp_full_match(term, '[\p{{L}}\p{{M}}\p{{N}}]{{2,}}'))"""


@query(
    "tfidf_top",
    f"""WITH {_TERMS}, c AS (SELECT term, count(*) AS tf FROM kept GROUP BY 1)
        SELECT term, tf, round(tf / (SELECT sqrt(sum(CAST(tf AS DOUBLE) * tf)) FROM c), 6) AS tfidf
        FROM c ORDER BY tf DESC, term LIMIT 20""",
)
def tfidf_top(t):
    top = X.tfidf_top(t.documents, "text", 20, stop_words=ENGLISH)
    return top.withColumn("tfidf", F.round("tfidf", 6))


@query(
    "tfidf_top_per_document",
    f"""WITH {_TERMS},
          c AS (SELECT doc_id, term, count(*) AS tf FROM kept GROUP BY 1, 2),
          d AS (SELECT term, count(*) AS docs FROM c GROUP BY 1),
          w AS (SELECT doc_id, term, tf,
                       tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + docs)) + 1.0) AS w
                FROM c JOIN d USING (term)),
          s AS (SELECT doc_id, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS s FROM w)
        SELECT doc_id, term, tf, round(s, 6) AS tfidf,
               CAST(row_number() OVER (PARTITION BY doc_id ORDER BY round(s, 12) DESC, term) AS INTEGER) AS rank
        FROM s QUALIFY rank <= 20""",
)
def tfidf_top_per_document(t):
    top = X.tfidf_top(t.documents, "text", 20, doc="doc_id", stop_words=ENGLISH, doc_is_row=True)
    return top.withColumn("tfidf", F.round("tfidf", 6))


@query("distinct_values", "SELECT DISTINCT lang FROM documents")
def distinct_values(t):
    return X.distinct_values(t.documents, "lang")


@query(
    "distinct_values_first_seen",
    "SELECT event_type, min(event_id) AS first_seen FROM events GROUP BY 1",
)
def distinct_values_first_seen(t):
    return X.distinct_values(t.events, "event_type", "event_id")


@query(
    "profile",
    f"""WITH {MESSAGES}
        SELECT 'uptake' AS "column", 'string' AS type, count(*) AS rows, count(uptake) AS non_null,
               count(*) - count(uptake) AS nulls FROM messages
        UNION ALL SELECT 'course', 'string', count(*), count(course), count(*) - count(course) FROM messages
        UNION ALL SELECT 'turn', 'bigint', count(*), count(turn), count(*) - count(turn) FROM messages""",
)
def profile(t):
    return X.profile(messages(t).select("uptake", "course", "turn"))


@query(
    "sample_rows",
    "SELECT event_id, event_type FROM events ORDER BY md5('42|' || event_id) LIMIT 100",
)
def sample_rows(t):
    return X.sample_rows(t.events.select("event_id", "event_type"), "event_id", 100)


@query(
    "max_text_length",
    """SELECT doc_id, text, CAST(length(text) AS INTEGER) AS length FROM documents
       ORDER BY length(text) DESC, doc_id LIMIT 1""",
)
def max_text_length(t):
    return X.longest_text(t.documents, "text", "doc_id")


@query(
    "length_bucket",
    f"""SELECT doc_id, CAST(CASE WHEN n <= 1 THEN 1 ELSE least(512, pow(2, ceil(log2(n)))) END AS BIGINT) AS bucket
        FROM (SELECT doc_id, len({sql_tokens('text')}) AS n FROM documents)""",
)
def length_bucket(t):
    return t.documents.select("doc_id", bucket(F.size(tokens("text"))).alias("bucket"))


@query("head", "SELECT event_id, event_type FROM events ORDER BY ts, event_id LIMIT 5")
def head(t):
    return X.head(t.events, 5, ["ts", "event_id"]).select("event_id", "event_type")


@query(
    "as_class",
    f"WITH {MESSAGES} SELECT conv_id, turn, coalesce(uptake, 'None') AS uptake FROM messages",
)
def missing_as_class(t):
    return messages(t).select("conv_id", "turn", as_class("uptake").alias("uptake"))
