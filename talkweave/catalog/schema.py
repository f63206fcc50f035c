"""B: schema operations and projections."""

from pyspark.sql import functions as F

from ..functions.text import combine_fields as combine
from ..functions.text import id_with_name
from ..operators import schema as S
from .derive import MESSAGES, RATERS, messages, raters
from .registry import query


def _twins(t):
    """Documents with a copied column, a nearly copied one and helper columns."""
    return t.documents.select(
        "doc_id",
        "lang",
        "n_chars",
        F.col("lang").alias("language"),
        F.length("text").cast("bigint").alias("n_text"),
        F.when(F.col("doc_id") > 0, F.col("lang")).alias("lang.1"),
        F.col("source").alias("R1Source"),
        F.col("source").alias("Binary Source"),
    )


_SAME_TYPE = (
    ("lang", "language", "lang", "lang"),
    ("doc_id", "n_chars", "doc_id", "n_chars"),
    ("doc_id", "n_text", "doc_id", "length(text)"),
    ("n_chars", "n_text", "n_chars", "length(text)"),
)


@query(
    "drop_equal_columns",
    " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, bool_and({x} IS NOT DISTINCT FROM {y}) AS equal FROM documents"
        for a, b, x, y in _SAME_TYPE
    ),
)
def equal_columns(t):
    return S.equal_column_report(_twins(t), ["doc_id", "lang", "n_chars", "language", "n_text"])


@query("drop_prefixed", "SELECT doc_id, lang, lang AS language, n_chars, length(text) AS n_text FROM documents")
def drop_prefixed(t):
    return S.drop_suffix_duplicates(S.drop_prefixed(_twins(t), ["R1", "Binary"]))


@query(
    "drop_suffix_duplicates",
    """SELECT 'lang' AS "column", count(*) FILTER (WHERE lang IS NULL AND doc_id > 0) AS only_in_duplicate
       FROM documents""",
)
def suffix_duplicates(t):
    return S.suffix_duplicate_report(_twins(t))


@query("rename", "SELECT conv_id AS book_id, turn AS position, text AS message FROM conversations")
def rename(t):
    df = t.conversations.drop("role")
    return S.rename(df, {"conv_id": "book_id", "turn": "position", "text": "message"})


@query("camel_columns", 'SELECT conv_id AS "BookID", turn AS "MessageNumber" FROM conversations')
def camel_columns(t):
    df = t.conversations.select(F.col("conv_id").alias("Book ID"), F.col("turn").alias("message number"))
    return S.camel_columns(df)


def _rater_table(t):
    r = raters(t)
    return r.select(
        "event_id",
        F.col("r1").alias("R1Uptake"),
        F.when(F.col("event_id") % 13 == 0, "").otherwise(F.col("r2")).alias("R2Uptake"),
        F.col("r1").alias("BinaryR1Memo"),
        F.col("r3").alias("BinaryR2Memo"),
    )


_R2 = "CASE WHEN event_id % 13 = 0 THEN '' ELSE r2 END"


@query(
    "backfill_pairs",
    f"""WITH {RATERS}
        SELECT event_id, r1 AS "R1Uptake", coalesce(nullif({_R2}, ''), r1) AS "R2Uptake",
               r1 AS "BinaryR1Memo", r3 AS "BinaryR2Memo" FROM raters""",
)
def backfill_pairs(t):
    df = _rater_table(t)
    return S.backfill_pairs(df, S.rater_pairs(df.columns))


@query(
    "backfill_report",
    f"""WITH {RATERS}
        SELECT 'R1Uptake' AS first, 'R2Uptake' AS second,
               count(*) FILTER (WHERE ({_R2} IS NULL OR {_R2} = '') AND r1 IS NOT NULL) AS missing FROM raters
        UNION ALL
        SELECT 'BinaryR1Memo', 'BinaryR2Memo', count(*) FILTER (WHERE r3 IS NULL) FROM raters""",
)
def backfill_report(t):
    df = _rater_table(t)
    return S.backfill_report(df, S.rater_pairs(df.columns))


@query(
    "cast_columns",
    f"""WITH {MESSAGES}
        SELECT conv_id, turn, try_cast(trim(dialogic_spell) AS BIGINT) AS dialogic_spell,
               try_cast(page AS DOUBLE) AS page FROM messages""",
)
def cast_columns(t):
    df = messages(t).select("conv_id", "turn", "dialogic_spell", "page")
    return S.cast_columns(df, {"dialogic_spell": "bigint", "page": "double"})


@query(
    "align_schemas",
    """SELECT doc_id, text FROM documents UNION ALL SELECT page_id, html FROM pages""",
)
def align_schemas(t):
    a = t.documents
    b = t.pages.select(F.col("html").alias("text"), F.col("page_id").alias("doc_id"), "url")
    a, b = S.align_schemas(a, b)
    return a.union(b)


@query(
    "combine_fields",
    f"""WITH {MESSAGES}
        SELECT conv_id, turn, concat_ws(': ', course, page, message) AS text,
               CASE WHEN course IS NOT NULL THEN conv_id || ' (' || course || ')' END AS pseudonym
        FROM messages""",
)
def combine_fields(t):
    return messages(t).select(
        "conv_id",
        "turn",
        combine(["course", "page", "message"], ": ").alias("text"),
        id_with_name("conv_id", "course").alias("pseudonym"),
    )


@query("select_columns", "SELECT event_id, event_type, ts FROM events")
def select_columns(t):
    return S.select_columns(t.events, drop=["props", "value", "user_id"])
