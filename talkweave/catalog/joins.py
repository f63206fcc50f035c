"""I: joins and appends."""

from pyspark.sql import functions as F

from ..operators import joins as J
from .derive import PREDS, RUNS, RUNS_SQL, preds, runs
from .registry import query

# passages: every earlier turn of a conversation, ranked by nearness to the last one
_CONTEXT = """ctx AS (
    SELECT conv_id AS row_id, turn + 1 AS rank, text FROM conversations WHERE conv_id % 4 != 3)"""


def _context(t):
    return t.conversations.filter(F.col("conv_id") % 4 != 3).select(
        F.col("conv_id").alias("row_id"), (F.col("turn") + 1).alias("rank"), "text"
    )


@query(
    "attach_context",
    f"""WITH {_CONTEXT}
        SELECT c.conv_id AS row_id, c.turn, c.role,
               coalesce((SELECT string_agg(x.text, ' || ' ORDER BY x.rank) FROM ctx x
                         WHERE x.row_id = c.conv_id AND x.rank <= 2), '') AS context
        FROM conversations c""",
)
def attach_context(t):
    """Every turn with the first two passages of its conversation; one conversation in four has none."""
    rows = t.conversations.select(F.col("conv_id").alias("row_id"), "turn", "role")
    done = J.attach_context(rows, _context(t))
    return done.withColumn("context", F.array_join("context", " || "))


@query("pivot_predictions", f"WITH {RUNS_SQL} SELECT event_id, label, bert, llama, mistral FROM runs")
def pivot_predictions(t):
    wide = J.pivot_predictions(preds(t), list(RUNS), key="event_id")
    truth = runs(t).select("event_id", "label")
    return truth.join(wide, "event_id")


@query(
    "join_on_index",
    f"""WITH {PREDS} SELECT e.event_id, e.props, p.run_id, p.label FROM events e JOIN preds p ON e.event_id = p.event_id""",
)
def join_on_index(t):
    return J.join_on_index(t.events.select("event_id", "props"), preds(t), "event_id")


@query(
    "join_on_text",
    """SELECT a.text, a.lang, b.source, count(*) AS pairs
       FROM documents a JOIN documents b ON a.text = b.text GROUP BY 1, 2, 3""",
)
def join_on_text(t):
    """All copies among documents, counted per (text, language, source)."""
    return J.join_on_text(t.documents, t.documents, "text", ["lang"], ["source"])


@query(
    "exclude_examples",
    """SELECT doc_id FROM documents d WHERE NOT EXISTS
         (SELECT 1 FROM documents e WHERE e.doc_id % 50 = 0 AND e.text = d.text)""",
)
def exclude_examples(t):
    """Every fiftieth document serves as an example; its copies go too."""
    examples = t.documents.filter(F.col("doc_id") % 50 == 0)
    return J.exclude_examples(t.documents, examples, "text").select("doc_id")


@query(
    "stack_sources",
    """SELECT doc_id, text, lang, CAST(NULL AS VARCHAR) AS role FROM documents
       UNION ALL SELECT conv_id, text, NULL, role FROM conversations""",
)
def stack_sources(t):
    chats = t.conversations.select(F.col("conv_id").alias("doc_id"), "text", "role")
    return J.stack_sources(t.documents.select("doc_id", "text", "lang"), chats)


@query(
    "lookup",
    "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
)
def lookup(t):
    return J.lookup(t.documents.select("doc_id", "lang"), t.labels, "doc_id")
