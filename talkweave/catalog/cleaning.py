"""C and D: filters, scalar cleaning, row generators."""

from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions import text as X
from ..operators import rows as R
from .derive import (
    MESSAGES,
    messages,
    sql_blank,
    sql_list,
    sql_sentences,
    sql_strip,
    sql_tokens,
)
from .registry import query

KEYS = ("conv_id", "turn")


@query("keep_prefix", "SELECT doc_id, source FROM documents WHERE starts_with(source, 'src1')")
def keep_prefix(t):
    return R.keep_prefix(t.documents.select("doc_id", "source"), "source", "src1")


@query(
    "number_word",
    f"""WITH {MESSAGES}
        SELECT conv_id, turn, CAST(map {{'One': 1, 'Seven': 7, 'Twenty': 20, 'Twenty-One': 21}}
                 [string_split(bookclub, ' ')[-1]] AS INTEGER) AS bookclub
        FROM messages WHERE starts_with(bookclub, 'Book')""",
)
def number_word(t):
    df = R.keep_prefix(messages(t).select(*KEYS, "bookclub"), "bookclub", "Book")
    return df.withColumn("bookclub", L.number_word("bookclub"))


def _null_if_blank(c):
    return f"CASE WHEN {c} = '?' OR {sql_blank(c)} THEN NULL ELSE {c} END"


@query(
    "blank_to_null",
    f"""WITH {MESSAGES} SELECT conv_id, turn, {_null_if_blank('page')} AS page,
        {_null_if_blank('uptake')} AS uptake FROM messages""",
)
def blank_to_null(t):
    return messages(t).select(*KEYS, *[L.blank_to_null(c).alias(c) for c in ("page", "uptake")])


@query(
    "blank_to_none_label",
    f"""WITH {MESSAGES} SELECT conv_id, turn,
        coalesce({_null_if_blank('uptake')}, 'None') AS uptake,
        coalesce({_null_if_blank('dialogic_spell')}, 'None') AS dialogic_spell FROM messages""",
)
def blank_to_none_label(t):
    cols = [L.blank_to_none_label(c).alias(c) for c in ("uptake", "dialogic_spell")]
    return messages(t).select(*KEYS, *cols)


@query(
    "is_answer",
    f"""WITH {MESSAGES} SELECT conv_id, turn, is_answer IS NULL OR {sql_blank('is_answer')} AS is_answer
        FROM messages""",
)
def is_answer(t):
    return messages(t).select(*KEYS, L.is_answer("is_answer").alias("is_answer"))


@query(
    "strip_marker",
    f"""WITH {MESSAGES} SELECT conv_id, turn,
        CASE WHEN course[1:1] = '?' THEN course[3:] ELSE course END AS course FROM messages""",
)
def strip_marker(t):
    return messages(t).select(*KEYS, L.strip_marker("course").alias("course"))


RESPELL = {"Imaginative entry": "Imaginative Entry", "Imaginative": "Imaginative Entry"}


@query(
    "remap",
    f"""WITH {MESSAGES} SELECT conv_id, turn,
        {sql_strip("CASE WHEN discussion_type IN ('Imaginative entry', 'Imaginative') THEN 'Imaginative Entry' ELSE discussion_type END")}
          AS discussion_type,
        CASE WHEN uptake = 'Prompt' THEN NULL ELSE {sql_strip('uptake')} END AS uptake FROM messages""",
)
def remap(t):
    return messages(t).select(
        *KEYS,
        L.remap("discussion_type", RESPELL).alias("discussion_type"),
        L.remap("uptake", {"Prompt": None}).alias("uptake"),
    )


QUESTIONS = ["C-HOT", "O-HOT", "C-LOT", "O-LOT"]


@query(
    "allow_list",
    f"""WITH {MESSAGES} SELECT conv_id, turn,
        CASE WHEN list_contains({sql_list(QUESTIONS)}, question) THEN question ELSE 'None' END AS question
        FROM messages""",
)
def allow_list(t):
    return messages(t).select(*KEYS, L.allow_list("question", QUESTIONS).alias("question"))


@query(
    "allow_list_offenders",
    f"""WITH {MESSAGES} SELECT conv_id, turn, question FROM messages
        WHERE question IS NOT NULL AND question NOT IN ('C-HOT', 'O-HOT', 'C-LOT', 'O-LOT')""",
)
def allow_list_offenders(t):
    return R.outside_allow_list(messages(t).select(*KEYS, "question"), "question", QUESTIONS)


@query(
    "drop_null_messages",
    f"""WITH {MESSAGES} SELECT conv_id, turn FROM messages
        WHERE message IS NOT NULL AND uptake IS NOT NULL AND course IS NOT NULL""",
)
def drop_null_messages(t):
    return R.drop_null_rows(messages(t), ["message", "uptake", "course"]).select(*KEYS)


@query(
    "drop_tail",
    """SELECT user_id, event_id FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) > 2""",
)
def drop_tail(t):
    df = t.events.select("user_id", "ts", "event_id")
    return R.drop_tail(df, 2, ["ts", "event_id"], ["user_id"]).drop("ts")


@query(
    "drop_tail_ties",
    """SELECT event_type, day FROM (
         SELECT event_type, CAST(ts AS DATE) AS day,
                row_number() OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE) DESC) AS back FROM events) WHERE back > 25""",
)
def drop_tail_ties(t):
    """Rows alike in every column: exactly 25 go from each kind, however many share the last day."""
    df = t.events.select("event_type", F.to_date("ts").alias("day"))
    return R.drop_tail(df, 25, ["day"], ["event_type"])


@query("filter_eq", "SELECT event_id, value FROM events WHERE event_type = 'purchase'")
def filter_eq(t):
    return R.filter_eq(t.events, "event_type", "purchase").select("event_id", "value")


@query(
    "filter_ne",
    f"WITH {MESSAGES} SELECT conv_id, turn, course FROM messages WHERE course IS DISTINCT FROM 'F20'",
)
def filter_ne(t):
    return R.filter_ne(messages(t), "course", "F20").select(*KEYS, "course")


@query(
    "fill",
    f"""WITH {MESSAGES} SELECT conv_id, turn, coalesce(uptake, 'None') AS uptake,
        coalesce(page, '0') AS page FROM messages""",
)
def fill(t):
    return R.fill(messages(t).select(*KEYS, "uptake", "page"), {"uptake": "None", "page": "0"})


@query(
    "parse_time",
    f"""WITH {MESSAGES} SELECT conv_id, turn,
        strftime(try_cast(time AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS time FROM messages""",
)
def parse_time(t):
    parsed = L.parse_time("time", "yyyy-MM-dd HH:mm:ss")
    return messages(t).select(*KEYS, F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("time"))


@query(
    "time_parts",
    """SELECT event_id, CAST(minute(ts) AS INTEGER) AS minute, CAST(hour(ts) AS INTEGER) AS hour,
              CAST(day(ts) AS INTEGER) AS day, CAST(month(ts) AS INTEGER) AS month,
              CAST(year(ts) AS INTEGER) AS year, CAST(second(ts) AS INTEGER) AS second,
              CAST(ts AS DATE) AS date FROM events""",
)
def time_parts(t):
    return t.events.select("event_id", *L.time_parts("ts"))


@query(
    "sentences",
    f"""SELECT doc_id, CAST(len({sql_sentences('text')}) AS INTEGER) AS n,
               array_to_string({sql_sentences('text')}, ' | ') AS sentences FROM documents""",
)
def sentences(t):
    parts = t.documents.select("doc_id", X.sentences("text").alias("s"))
    return parts.select("doc_id", F.size("s").alias("n"), F.array_join("s", " | ").alias("sentences"))


@query(
    "tokens",
    f"""SELECT doc_id, CAST(len({sql_tokens('text')}) AS INTEGER) AS n,
               array_to_string({sql_tokens('text')}, ' ') AS tokens FROM documents""",
)
def tokens(t):
    parts = t.documents.select("doc_id", X.tokens("text").alias("s"))
    return parts.select("doc_id", F.size("s").alias("n"), F.array_join("s", " ").alias("tokens"))


# --- rows from multi-label cells ---------------------------------------------

_PARTS = f"""m AS (
    SELECT conv_id, turn, message, discussion_type, question, "pivot",
           list_transform(string_split(discussion_type, ','), lambda x: {sql_strip('x')}) AS labels,
           {sql_sentences('message')} AS pieces, string_split(question, ',') AS q
    FROM messages),
  c AS (SELECT *, CASE WHEN discussion_type IS NULL OR NOT contains(discussion_type, ',') THEN 'keep'
                       WHEN len(labels) = len(pieces) THEN 'split'
                       WHEN len(list_distinct(labels)) = 1 THEN 'equal' ELSE 'mixed' END AS branch
        FROM m)"""
_DIVIDED = f"CASE WHEN len(q) = len(labels) THEN {sql_strip('q[i + 1]')} ELSE question END"
_SINGLE = """SELECT conv_id, turn, message,
         CASE branch WHEN 'keep' THEN discussion_type WHEN 'equal' THEN labels[1] ELSE @mixed END AS discussion_type,
         question, "pivot", 0 AS part_no FROM c WHERE branch IN (@branches)"""
_MANY = f"""SELECT conv_id, turn, CASE WHEN branch = 'split' THEN pieces[i + 1] ELSE message END AS message,
         labels[i + 1] AS discussion_type, {_DIVIDED} AS question,
         CASE WHEN i = len(labels) - 1 THEN "pivot" END AS pivot, CAST(i AS INTEGER) AS part_no
       FROM c, unnest(range(len(labels))) AS u(i) WHERE branch IN (@branches)"""

COLUMNS = (*KEYS, "message", "discussion_type", "question", "pivot")


@query(
    "split_multilabel",
    f"WITH {MESSAGES}, {_PARTS} "
    + _SINGLE.replace("@mixed", "'Other'").replace("@branches", "'keep', 'equal', 'mixed'")
    + " UNION ALL "
    + _MANY.replace("@branches", "'split'"),
)
def split_multilabel(t):
    return R.split_multilabel(
        messages(t).select(*COLUMNS), "discussion_type", "message", ["question"], ["pivot"], "Other"
    )


@query(
    "split_multilabel_duplicate",
    f"WITH {MESSAGES}, {_PARTS} "
    + _SINGLE.replace("@mixed", "NULL").replace("@branches", "'keep', 'equal'")
    + " UNION ALL "
    + _MANY.replace("@branches", "'split', 'mixed'"),
)
def split_multilabel_duplicate(t):
    return R.split_multilabel(
        messages(t).select(*COLUMNS),
        "discussion_type",
        "message",
        ["question"],
        ["pivot"],
        mode="duplicate",
    )


CORRECTIONS = [
    ("The", 1, "First half.", "Deliberation"),
    ("The", 2, "Second half.", "Seminar"),
    ("An", 1, "Only part.", "Social"),
]


@query(
    "apply_corrections",
    """WITH hit AS (
         SELECT conv_id, turn, text, role,
                CASE WHEN starts_with(text, 'The') THEN 'The' WHEN starts_with(text, 'An') THEN 'An' END AS p
         FROM conversations),
       first_hit AS (
         SELECT *, p IS NOT NULL AND row_number() OVER (PARTITION BY p ORDER BY conv_id, turn) = 1 AS f
         FROM hit)
       SELECT conv_id, turn, text, role, 0 AS part_no FROM first_hit WHERE NOT f
       UNION ALL
       SELECT conv_id, turn, x.t, x.l, x.n FROM first_hit,
         (VALUES ('The', 0, 'First half.', 'Deliberation'), ('The', 1, 'Second half.', 'Seminar'),
                 ('An', 0, 'Only part.', 'Social')) AS x(p, n, t, l)
       WHERE f AND x.p = first_hit.p""",
)
def apply_corrections(t):
    return R.apply_corrections(t.conversations, CORRECTIONS, "text", "role", KEYS)


@query(
    "apply_corrections_ties",
    """WITH n AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
       SELECT event_type AS text, 'raw' AS label, 0 AS part_no FROM n, unnest(range(n - (event_type IN ('view', 'click'))::INT)) AS u(i)
       UNION ALL SELECT * FROM (VALUES ('seen', 'A', 0), ('looked at', 'B', 1), ('pressed', 'C', 0)) AS x(t, l, p)""",
)
def apply_corrections_ties(t):
    """All rows of a kind are alike; of each corrected kind one row is replaced."""
    df = t.events.select(F.col("event_type").alias("text"), F.lit("raw").alias("label"))
    fixes = [("view", 1, "seen", "A"), ("view", 2, "looked at", "B"), ("click", 1, "pressed", "C")]
    return R.apply_corrections(df, fixes, "text", "label", ["text"])


@query(
    "apply_correction_table",
    """WITH fix AS (SELECT DISTINCT split_part(text, ' ', 1) || ' ' || split_part(text, ' ', 2) AS prefix FROM documents WHERE text LIKE '% % %'),
       hit AS (SELECT c.conv_id, c.turn, min(f.prefix) AS p FROM conversations c JOIN fix f ON starts_with(c.text, f.prefix) GROUP BY ALL),
       one AS (SELECT * FROM hit QUALIFY row_number() OVER (PARTITION BY p ORDER BY conv_id, turn) = 1)
       SELECT conv_id, turn, coalesce(x.t, text) AS text, coalesce(x.l, role) AS role, CAST(coalesce(x.n, 0) AS INTEGER) AS part_no
       FROM conversations LEFT JOIN one USING (conv_id, turn)
       LEFT JOIN (VALUES ('first', 'A', 0), ('second', 'B', 1)) AS x(t, l, n) ON one.p IS NOT NULL""",
)
def apply_correction_table(t):
    """As many corrections as documents have different openings of two words."""
    words = F.split("text", " ")
    openings = t.documents.filter("text LIKE '% % %'").select(F.concat_ws(" ", F.get(words, F.lit(0)), F.get(words, F.lit(1))).alias("prefix")).distinct()
    parts = F.array(*[F.struct(F.lit(i).alias("seq"), F.lit(x).alias("text"), F.lit(y).alias("label")) for i, (x, y) in enumerate([("first", "A"), ("second", "B")])])
    fixes = openings.select("prefix", F.lit(0).alias("place"), F.inline(parts))
    return R.apply_correction_table(t.conversations, fixes, "text", "role", KEYS)
