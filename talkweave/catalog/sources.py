"""A: sources and sinks."""

from pyspark.sql import functions as F

from ..operators.rows import with_row_id
from ..session import scratch_path
from ..sources import codebook, predictions, story
from ..sources.tables import read_messages, spread, write_table
from ..functions.text import ENTITY_NAMES
from .derive import pick, sql_list, sql_strip, sql_text
from .registry import query

ALL_MESSAGES = "SELECT conv_id, turn, role, text FROM conversations"


@query("read_messages", ALL_MESSAGES)
def messages_from_csv(t):
    """Messages with quotes and line breaks written as CSV and read with a schema."""
    path = scratch_path(t.spark, "messages")
    write_table(t.conversations, path, fmt="csv")
    return read_messages(t.spark, path, "conv_id bigint, turn bigint, role string, text string")


@query("write_table", ALL_MESSAGES)
def partitioned_table(t):
    path = scratch_path(t.spark, "by_role")
    write_table(t.conversations, path, ["role"])
    return t.spark.read.parquet(path).select("conv_id", "turn", "role", "text")


def _books(t):
    """A two-page book per message: the text in the first state, the role on page two."""
    safe = F.regexp_replace(F.replace("text", F.lit("]]>"), F.lit("")), r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    xml = F.concat(
        F.lit("<?xml version='1.0'?><book><page type_id='1'><state><text><![CDATA[<p></p>\n<p>"),
        safe,
        F.lit(
            "</p>\n]]></text></state><state><text>not read</text></state></page>"
            "<page type_id='2'><state/><state><text> "
        ),
        F.col("role"),
        F.lit("</text></state></page></book>"),
    )
    return spread(t.conversations, "conv_id").select("conv_id", "turn", xml.alias("xml"))


_SAFE = r"regexp_replace(replace(replace(text, ']]>', ''), chr(13) || chr(10), chr(10)), '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g')"


@query(
    "read_story",
    f"""WITH b AS (SELECT conv_id, turn, role, {_SAFE} AS body FROM conversations)
        SELECT conv_id, turn, 1 AS page_no, '1' AS type_id,
               '<p></p>' || chr(10) || '<p>' || body || '</p>' AS text FROM b
        UNION ALL
        SELECT conv_id, turn, 2, '2', role FROM b""",
)
def read_story(t):
    return _books(t).select("conv_id", "turn", F.inline(story.story_pages("xml")))


@query(
    "story_text",
    f"""WITH b AS (SELECT conv_id, turn, role, {_SAFE} AS body FROM conversations)
        SELECT conv_id, turn,
               {sql_strip("regexp_replace(chr(10) || replace(replace(body, '<p>', ''), '</p>', chr(10)) || chr(10) || role, chr(10) || '+', chr(10), 'g')")} AS text
        FROM b""",
)
def story_text(t):
    return _books(t).select("conv_id", "turn", story.story_text(story.story_pages("xml")).alias("text"))


_ENTITY = "&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
_NAMED = "map {" + ", ".join(f"'{n}': {sql_text(c)}" for n, c in ENTITY_NAMES.items()) + "}"


def _sql_unescape(x):
    """The text between references and what each reference stands for, in turn."""
    number = (
        "CASE WHEN starts_with(e, '&#x') OR starts_with(e, '&#X') THEN CAST('0x' || e[4:-2] AS BIGINT) "
        "ELSE CAST(e[3:-2] AS BIGINT) END"
    )
    valid = f"({number}) BETWEEN 1 AND 1114111 AND NOT ({number}) BETWEEN 55296 AND 57343"
    char = (
        f"CASE WHEN starts_with(e, '&#') THEN CASE WHEN {valid} THEN chr(CAST({number} AS INTEGER)) ELSE chr(65533) END "
        f"ELSE coalesce({_NAMED}[e], e) END"
    )
    return f"""(SELECT array_to_string(list_transform(range(1, len(g) + 1),
                  lambda k: g[k] || CASE WHEN k <= len(m) THEN list_transform([m[k]], lambda e: {char})[1] ELSE '' END), '')
                FROM (SELECT string_split_regex(y, '{_ENTITY}') AS g, regexp_extract_all(y, '{_ENTITY}') AS m FROM (SELECT {x} AS y)))"""


_NO_TAGS = (
    r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, "
    r"'(?is)<script\b.*?</script>', ' ', 'g'), '(?is)<style\b.*?</style>', ' ', 'g'), "
    r"'(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g')"
)


# pages that name their characters in every way a page can
_MARKED = ["&#160;", "&eacute;&apos;", "&#x27;&#X1F600;", "&mdash; &amp;lt;", "&unknown; & &;", "&#0;&#55296;"]
_HTML = f"html || '<p>' || {sql_list(_MARKED)}[1 + page_id % {len(_MARKED)}] || '</p>'"


@query(
    "html_text",
    rf"""WITH p AS (SELECT page_id, url, {_HTML} AS html FROM pages)
        SELECT page_id, url,
               {_sql_unescape("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title,
               {sql_strip("regexp_replace(" + _sql_unescape(_NO_TAGS) + r", '[ \t\n\r\f\x0B\x{A0}]+', ' ', 'g')")} AS text
        FROM p""",
)
def html_text(t):
    marked = F.concat("html", F.lit("<p>"), pick(F.col("page_id"), _MARKED), F.lit("</p>"))
    return story.page_texts(t.pages.withColumn("html", marked))


def raw_codebook(t):
    """One ``lang: source`` term per source, defined by its first document's text."""
    first = F.min_by(F.struct("text", "n_chars"), "doc_id")
    return (
        t.documents.groupBy("lang", "source")
        .agg(first.alias("f"))
        .select(
            F.concat("lang", F.lit(": "), "source", F.lit(" ")).alias("Term"),
            F.when(F.col("f.n_chars") % 3 != 0, F.col("f.text")).alias("Definition"),
            F.when(F.col("f.n_chars") % 2 == 0, F.concat(F.lit("see\n"), "source")).alias("Example"),
        )
    )


CODEBOOK = """codebook AS (
    SELECT lang AS class, source AS term,
           CASE WHEN arg_min(n_chars, doc_id) % 3 != 0 THEN arg_min(text, doc_id) END AS definition,
           CASE WHEN arg_min(n_chars, doc_id) % 2 = 0 THEN 'see' || chr(10) || source END AS example
    FROM documents GROUP BY lang, source)"""


@query("read_codebook", f"WITH {CODEBOOK} SELECT * FROM codebook")
def read_codebook(t):
    return codebook.read_codebook(raw_codebook(t))


_CLASSES = "['Discussion', 'Uptake', 'Question', 'Pivot']"
RUN_ROWS = f"""run_rows AS (
    SELECT event_id, event_type AS method, {_CLASSES}[1 + (event_id % 4)] AS class,
           event_id % 3 > 0 AS use_history, event_id % 2 = 0 AS use_past_labels,
           event_id % 5 = 0 AS use_context, CASE WHEN event_id % 7 = 0 THEN 'final' END AS extra
    FROM events)"""


def run_rows(t):
    i = F.col("event_id")
    classes = F.array(*map(F.lit, ("Discussion", "Uptake", "Question", "Pivot")))
    return t.events.select(
        "event_id",
        F.col("event_type").alias("method"),
        F.get(classes, (i % 4).cast("int")).alias("class"),
        (i % 3 > 0).alias("use_history"),
        (i % 2 == 0).alias("use_past_labels"),
        (i % 5 == 0).alias("use_context"),
        F.when(i % 7 == 0, "final").alias("extra"),
    )


@query(
    "run_suffix",
    f"""WITH {RUN_ROWS}
        SELECT event_id,
          CASE WHEN use_past_labels AND NOT use_history THEN NULL ELSE
            '_' || lower(class)
            || CASE WHEN use_history OR use_context OR extra IS NOT NULL THEN '_w' ELSE '' END
            || CASE WHEN use_history THEN '_history' ELSE '' END
            || CASE WHEN use_history AND use_past_labels THEN '_past-labels' ELSE '' END
            || CASE WHEN use_context THEN '_context' ELSE '' END
            || CASE WHEN extra IS NOT NULL THEN '_' || extra ELSE '' END END AS suffix
        FROM run_rows""",
)
def run_suffix(t):
    suffix = predictions.run_suffix_col("class", "use_history", "use_past_labels", "use_context", "extra")
    return run_rows(t).select("event_id", suffix.alias("suffix"))


@query(
    "parse_run_name",
    f"""WITH {RUN_ROWS}
        SELECT event_id, method,
               CASE WHEN event_id % 4 < 2 THEN lower(class) END AS class,
               event_id % 4 < 2 AND use_history AS use_history,
               event_id % 4 < 2 AND use_context AS use_context,
               event_id % 4 < 2 AND use_history AND use_past_labels AS use_past_labels
        FROM run_rows WHERE use_history OR NOT use_past_labels""",
)
def parse_run_name(t):
    """Whole names, names without a class and names with an empty one."""
    i = F.col("event_id") % 4
    suffix = predictions.run_suffix_col("class", "use_history", "use_past_labels", "use_context", "extra")
    name = F.concat("method", F.when(i < 2, suffix).when(i == 2, "_").otherwise(""), F.lit(".npy"))
    named = run_rows(t).filter(F.col("use_history") | ~F.col("use_past_labels"))
    return named.select("event_id", *predictions.parse_run_name(name))


@query(
    "load_predictions",
    f"""WITH {RUN_ROWS} SELECT event_id, method, class FROM run_rows WHERE class = 'Uptake'""",
)
def load_predictions(t):
    """Stored by class; only the wanted class's folder is read back."""
    path = scratch_path(t.spark, "predictions")
    predictions.write_predictions(run_rows(t), path)
    stored = predictions.read_predictions(t.spark, path, "upTAKE")
    return stored.select("event_id", "method", F.col("class"))


@query(
    "read_runs",
    f"""WITH {RUN_ROWS}
        SELECT event_id, 'method' AS method, lower(class) AS class, use_history, use_context, use_history AND use_past_labels AS use_past_labels
        FROM run_rows WHERE use_history OR NOT use_past_labels""",
)
def read_runs(t):
    """One folder per run; settings come back from the folders' names."""
    suffix = predictions.run_suffix_col("class", "use_history", "use_past_labels", "use_context")
    named = run_rows(t).filter(F.col("use_history") | ~F.col("use_past_labels"))
    path = scratch_path(t.spark, "runs")
    write_table(named.select("event_id", F.concat(F.lit("method"), suffix).alias("run")), path, ["run"])
    return predictions.read_runs(t.spark, path)


@query(
    "with_row_id",
    """SELECT conv_id, turn, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1 AS row_id
       FROM conversations""",
)
def row_ids(t):
    """Positions per role; a role is cut into blocks of 1,000 conversations."""
    df = t.conversations.select("role", "conv_id", "turn")
    return with_row_id(df, ["conv_id", "turn"], ["role"], block=1000).drop("role")
