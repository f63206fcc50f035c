"""Whole jobs, from table to report."""

from pyspark.sql import functions as F

from ..operators import retrieval
from ..functions.wording import EXPERT_LINE
from ..operators.prompts import MESSAGES as PROMPT, render_chat, turn
from ..plans import cleaning, coding, ensemble
from .cleaning import _PARTS
from .derive import MESSAGES, PREDS, messages, preds, runs, sql_blank, sql_list, sql_strip, sql_sentences
from .prompts import role_codebook
from .registry import query
from .retrieval import _sql_hashed

_GROUPS = "map {" + ", ".join(f"'{a}': '{b}'" for a, b in cleaning.PIVOT_GROUPS.items()) + "}"
_SPELL = "map {" + ", ".join(f"'{a}': '{b}'" for a, b in cleaning.PIVOT_SPELLING.items()) + "}"


def _null_if_blank(c):
    return f"CASE WHEN {c} = '?' OR {sql_blank(c)} THEN NULL ELSE {c} END"


_CLEAN = f"""{MESSAGES.replace('FROM conversations)', "FROM conversations WHERE conv_id % 6 NOT IN (3, 4))")}, {_PARTS},
  one AS (
    SELECT conv_id, turn, message,
           CASE branch WHEN 'keep' THEN discussion_type WHEN 'equal' THEN labels[1] ELSE 'Other' END AS kind,
           question, "pivot", 0 AS type_part FROM c WHERE branch != 'split'
    UNION ALL
    SELECT conv_id, turn, pieces[i + 1], labels[i + 1],
           CASE WHEN len(q) = len(labels) THEN {sql_strip('q[i + 1]')} ELSE question END,
           CASE WHEN i = len(labels) - 1 THEN "pivot" END, CAST(i AS INTEGER)
    FROM c, unnest(range(len(labels))) AS u(i) WHERE branch = 'split'),
  asked AS (
    SELECT conv_id, turn, type_part, message, "pivot",
           {sql_strip("CASE WHEN kind IN ('Imaginative entry', 'Imaginative') THEN 'Imaginative Entry' ELSE kind END")} AS kind,
           question, list_transform(string_split(question, ','), lambda x: {sql_strip('x')}) AS qs,
           {sql_sentences('message')} AS ps FROM one),
  branched AS (
    SELECT *, CASE WHEN question IS NULL OR NOT contains(question, ',') THEN 'keep'
                   WHEN len(qs) = len(ps) THEN 'split'
                   WHEN len(list_distinct(qs)) = 1 THEN 'equal' ELSE 'mixed' END AS b FROM asked),
  two AS (
    SELECT conv_id, turn, type_part, 0 AS question_part, message, kind,
           CASE b WHEN 'keep' THEN question WHEN 'equal' THEN qs[1] END AS question, "pivot"
    FROM branched WHERE b != 'split'
    UNION ALL
    SELECT conv_id, turn, type_part, CAST(i AS INTEGER), ps[i + 1], kind, qs[i + 1],
           CASE WHEN i = len(qs) - 1 THEN "pivot" END
    FROM branched, unnest(range(len(qs))) AS u(i) WHERE b = 'split'),
  ends AS (
    SELECT *, string_split({_null_if_blank('"pivot"')}, ' to ') AS p FROM two),
  pivots AS (
    SELECT *, CASE WHEN len(p) <= 2 THEN coalesce({_SPELL}[p[1]], p[1]) END AS f,
           CASE WHEN len(p) <= 2 THEN coalesce({_SPELL}[p[2]], p[2]) END AS t,
           {_GROUPS}[lag(kind) OVER (PARTITION BY conv_id ORDER BY turn, type_part, question_part)] AS gf,
           {_GROUPS}[kind] AS gt FROM ends)"""


def _cleaned(t):
    return cleaning.clean_messages(messages(t), ["turn"], ["conv_id"], block=3)


@query(
    "clean_messages",
    f"""WITH {_CLEAN}
        SELECT x.conv_id, x.turn, type_part, question_part, x.message, kind AS "Discussion",
               CASE WHEN list_contains({sql_list(cleaning.QUESTION_CLASSES)}, x.question) THEN x.question END AS "Question",
               {_null_if_blank('m.uptake')} AS "Uptake", 'from ' || f || ' to ' || t AS "Pivot",
               try_cast({_null_if_blank('m.dialogic_spell')} AS INTEGER) AS "Dialogic Spell",
               CASE WHEN f IS NOT NULL AND t IS NOT NULL AND gf IS NOT NULL AND gt IS NOT NULL THEN
                 CASE WHEN f = gf AND t = gt THEN 'corrected' ELSE 'misplaced' END END AS pivot_check
        FROM pivots x JOIN messages m ON x.conv_id = m.conv_id AND x.turn = m.turn""",
)
def clean_messages(t):
    return _cleaned(t).select(
        "conv_id", "turn", "type_part", "question_part", "message", "Discussion", "Question",
        "Uptake", "Pivot", "Dialogic Spell", "pivot_check",
    )


def role_model():
    """A rule for a model: reads the last turn of a rendered prompt and answers in a sentence."""

    def answer(prompts):
        last = prompts.str.rsplit("<user>", n=1).str[-1].str.removesuffix("</user>")
        lines = last.str.count("\n")
        out = last.map(lambda _: "Class: user, hardly an assistant")
        return out.mask(lines >= 1, "This is an assistant.").mask(last.str.len() < 120, "system")

    return answer


_RULE = """CASE WHEN length(text) < 120 THEN 'system' WHEN contains(text, chr(10)) THEN 'assistant' ELSE 'user' END"""


def _scored(t):
    df = t.conversations.withColumn("key", F.concat_ws(":", "conv_id", "turn"))
    rows = coding.coding_prompts(
        df, role_codebook(t), "Role", "role", "key", ["turn"], ["conv_id"], text="text",
        style="system", block=3,
    )
    return coding.scored_labels(rows, role_model, ["assistant", "system", "user"], render_chat("prompt"))


# the report over ``pairs`` (y, p) and ``classes``
_REPORT = """, per AS (SELECT class, (SELECT count(*) FROM pairs WHERE y = class) AS support,
                  (SELECT count(*) FROM pairs WHERE p = class) AS guessed,
                  (SELECT count(*) FROM pairs WHERE p = class AND y = class) AS hit FROM classes),
        m AS (SELECT class, support, hit, CASE WHEN guessed = 0 THEN 0 ELSE hit / guessed END AS pr,
                     CASE WHEN support = 0 THEN 0 ELSE hit / support END AS re,
                     2 * hit / (guessed + support) AS f1 FROM per)
        SELECT class, 'class' AS kind, round(pr, 6) AS precision, round(re, 6) AS recall, round(f1, 6) AS f1, support FROM m
        UNION ALL SELECT 'accuracy', 'summary', NULL, NULL, round(sum(hit) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m
        UNION ALL SELECT 'macro avg', 'summary', round(avg(pr), 6), round(avg(re), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM m
        UNION ALL SELECT 'weighted avg', 'summary', round(sum(pr * support) / sum(support), 6),
               round(sum(re * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM m"""


@query(
    "prompt_report",
    f"""WITH pairs AS (SELECT role AS y, {_RULE} AS p FROM conversations),
        classes AS (SELECT y AS class FROM pairs UNION SELECT p FROM pairs)
        {_REPORT}""",
)
def prompt_report(t):
    """Messages to history, prompts, answers, labels and the report over them."""
    done = coding.report(_scored(t))
    return done.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    "coding_prompts",
    f"""WITH r AS (SELECT conv_id || ':' || turn AS key, role AS label, {_RULE} AS predicted FROM conversations),
        k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || key), key) AS pos,
                     count(*) OVER (PARTITION BY label) AS n FROM r)
        SELECT key, label, predicted, CASE WHEN pos <= floor(n * 0.6::DOUBLE + 0.5) THEN 'train'
                    WHEN pos <= floor(n * 0.8::DOUBLE + 0.5) THEN 'validation' ELSE 'test' END AS split FROM k""",
)
def coding_prompts(t):
    return _scored(t).select("key", "label", "predicted", "split")


def length_model():
    """Scores for three roles from the length of the text."""
    import pandas as pd

    def rule(texts):
        n = texts.fillna("").str.len()
        return pd.Series([[float(x % 7), float(x % 5), float(x % 3)] for x in n], index=texts.index)

    return rule


@query(
    "zero_shot_report",
    f"""WITH s AS (SELECT role AS y, length(text) % 7 AS a, length(text) % 5 AS b, length(text) % 3 AS c FROM conversations),
        pairs AS (SELECT y, CASE WHEN a >= b AND a >= c THEN 'assistant' WHEN b >= c THEN 'system' ELSE 'user' END AS p FROM s),
        classes AS (SELECT y AS class FROM pairs UNION SELECT p FROM pairs)
        {_REPORT}""",
)
def zero_shot_report(t):
    """Scores per class, the best class, and the report over all messages."""
    done = coding.zero_shot(t.conversations, "text", length_model, ["assistant", "system", "user"])
    return coding.report(done, "role").withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


def echo_model():
    """Answers as asked, 'text // label'. The label comes from the examples' last line and the length of the message."""

    def answer(prompts):
        shown, asked = prompts.str.rsplit("\x1e", n=1).str[0], prompts.str.rsplit("\x1e", n=1).str[1]
        last = shown.str.rsplit(" // ", n=1).str[1].str.strip()
        out = asked + " // " + last
        out = out.mask(asked.str.len() % 3 == 1, asked + " // nonsense")
        return out.mask(asked.str.len() % 3 == 2, "perhaps user")

    return answer


_SHOWN = """ranked AS (SELECT *, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS r FROM conversations),
  shown AS (SELECT * FROM ranked WHERE r <= 2),
  asked AS (SELECT c.* FROM conversations c WHERE NOT EXISTS (SELECT 1 FROM shown s WHERE s.text = c.text))"""


@query(
    "few_shot",
    f"""WITH {_SHOWN}, last AS (SELECT trim(role) AS role FROM shown ORDER BY conv_id DESC, turn DESC LIMIT 1)
        SELECT conv_id, turn, role AS label,
               CASE length(text) % 3 WHEN 0 THEN (SELECT role FROM last) WHEN 1 THEN 'nonsense' ELSE 'user' END AS predicted
        FROM asked""",
)
def few_shot(t):
    """Two examples of each role in every prompt, left out of what is asked; answers parsed at the mark."""
    return coding.few_shot(
        t.conversations, "text", "role", ["conv_id", "turn"], echo_model, ["assistant", "system", "user"], n=2, between="\x1e"
    ).select("conv_id", "turn", F.col("role").alias("label"), "predicted")


@query(
    "few_shot_accuracy",
    f"""WITH {_SHOWN}, last AS (SELECT role FROM shown ORDER BY conv_id DESC, turn DESC LIMIT 1),
        done AS (SELECT role, CASE length(text) % 3 WHEN 0 THEN (SELECT role FROM last) WHEN 1 THEN 'nonsense' ELSE 'user' END AS p FROM asked)
        SELECT count(*) AS rows, round(avg((role = p)::INT), 6) AS accuracy FROM done""",
)
def few_shot_accuracy(t):
    right = (F.col("label") == F.col("predicted")).cast("int")
    return few_shot(t).agg(F.count("*").alias("rows"), F.round(F.avg(right), 6).alias("accuracy"))


@query(
    "expert_prompts",
    f"""WITH {PREDS}, w AS (SELECT event_id, max(label) FILTER (WHERE run_id = 'bert') AS b, max(label) FILTER (WHERE run_id = 'llama') AS l
                           FROM preds GROUP BY 1)
        SELECT event_id, 'first line' || chr(10) || props AS opening, 4 AS turns, coalesce(b, 'None') AS bert, coalesce(l, 'None') AS llama
        FROM events JOIN w USING (event_id)""",
)
def expert_prompts(t):
    """Every prompt asks about all runs' answers: what stays of the opening, the number of turns and each answer named in the last."""
    opening = F.concat(F.lit("first line\n"), "props")
    turns = F.array(turn("system", opening), turn("user", F.col("event_type")))
    rows = t.events.select("event_id", "props", turns.cast(PROMPT).alias("prompt"))
    done = ensemble.expert_prompts(rows, preds(t), ["bert", "llama"], key="event_id")
    last = F.element_at("prompt", -1)["content"]
    a, b, c = EXPERT_LINE

    def named(run):
        after = F.substring_index(last, a + run + b, -1)
        return F.substring_index(after, c, 1).alias(run)

    kept = F.substring_index(F.get("prompt", F.lit(0))["content"], "\n", -1)
    return done.select(
        "event_id", F.concat(F.lit("first line\n"), kept).alias("opening"), F.size("prompt").alias("turns"), named("bert"), named("llama")
    )


# two raw sources: even conversations as the first kind, odd ones as the second with three raters
_TWO = """raw AS (SELECT conv_id, turn, role, text, (conv_id * 10 + turn) % 6 AS m FROM conversations),
  one AS (SELECT 1 AS source, conv_id, turn, CASE WHEN m < 3 THEN 'UX' ELSE 'Other' END AS discussion_type,
                 NULL AS pseudonym, text AS message FROM raw WHERE conv_id % 2 = 0),
  voted AS (SELECT *, row_number() OVER (ORDER BY conv_id DESC, turn DESC) AS back FROM raw WHERE conv_id % 2 = 1),
  two AS (SELECT 2, conv_id, turn, CASE m WHEN 0 THEN 'Social' WHEN 1 THEN 'UX' WHEN 2 THEN 'UX' WHEN 3 THEN 'Other' WHEN 4 THEN 'Other' ELSE 'Social' END,
                 conv_id || ' (' || role || ')', text FROM voted WHERE back > 7)"""


@query("two_source_cleaning", f"WITH {_TWO} SELECT * FROM one UNION ALL SELECT * FROM two")
def two_source_cleaning(t):
    """Copied and marked columns go, three raters vote, the last seven rows of the second source go, names agree."""
    m = (F.col("conv_id") * 10 + F.col("turn")) % 6
    raw = t.conversations
    kind = F.when(m < 3, "UX").otherwise("Other")
    one = raw.filter("conv_id % 2 = 0").select(
        "conv_id", "turn", F.col("text").alias("Message"), kind.alias("R2DiscussionType"), kind.alias("Copy"),
        F.lit("x").alias("R1Memo"), F.lit(1).alias("BinaryUX"), F.lit("note").alias("Memo"),
    )
    first = F.when(m.isin(0, 5), "Social").when(m.isin(1, 2), "UX").otherwise("Other")
    second = F.when(m.isin(0, 1), F.lit(None)).otherwise(first)
    two = raw.filter("conv_id % 2 = 1").select(
        "conv_id", "turn", F.col("text").alias("Message"), F.col("conv_id").alias("User ID"), F.col("role").alias("Name"),
        first.alias("A Discussion Type"), second.alias("B Discussion Type"), F.lit(None).cast("string").alias("C Discussion Type"),
        first.alias("A Uptake"), first.alias("B Uptake"), first.alias("C Uptake"), F.lit(0).alias("Unnamed: 0"),
    )
    names = {"Message": "message", "R2DiscussionType": "discussion_type", "Discussion Type": "discussion_type", "Pseudonym": "pseudonym"}
    a = cleaning.two_rater_source(one, names, drop=["Memo"])
    b = cleaning.many_rater_source(two, names, drop_last=7, order=["conv_id", "turn"], raters=["A", "B", "C"])
    both = cleaning.combined(a, b)
    return both.select("source", "conv_id", "turn", "discussion_type", "pseudonym", "message")


@query(
    "vote_report",
    f"""WITH {PREDS}, w AS (SELECT event_id, label, count(*) AS w FROM preds GROUP BY 1, 2),
        v AS (SELECT event_id, label AS p FROM w
              QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY label IS NULL, w DESC, label) = 1),
        pairs AS (SELECT coalesce(r.label, 'None') AS y, coalesce(p, 'None') AS p FROM runs r JOIN v USING (event_id)),
        classes AS (SELECT y AS class FROM pairs UNION SELECT p FROM pairs)
        {_REPORT}""",
)
def vote_report(t):
    done = ensemble.vote_report(runs(t).select("event_id", "label"), preds(t), key="event_id")
    return done.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


_ASKED = """SELECT conv_id || ':' || turn AS id, coalesce(array_to_string(list(text) OVER (PARTITION BY conv_id ORDER BY turn
               ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), chr(10)) || chr(10), '') || text AS text FROM conversations"""
_STORY = """SELECT 'story:' || conv_id || ':' || turn || ':' || i AS id, text[i * 470 + 1 : i * 470 + 500] AS text
            FROM conversations, unnest(range(1 + greatest(length(text) - 31, 0) // 470)) AS u(i) WHERE length(text) > 0"""


@query(
    "retrieve_context",
    f"""WITH {_sql_hashed(_ASKED, 64).replace('hashed AS', 'asked AS')},
        {_sql_hashed(_STORY, 64).replace('hashed AS', 'told AS')},
        pairs AS (SELECT a.id AS key, b.id AS passage, list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS d
                  FROM asked a, told b)
        SELECT key, CAST(row_number() OVER (PARTITION BY key ORDER BY round(d, 9), passage) AS INTEGER) AS rank,
               round(d, 6) AS distance
        FROM pairs QUALIFY rank <= 5""",
)
def retrieve_context(t):
    """The five passages of all messages, cut into chunks, nearest to each message with its history."""
    df = t.conversations.withColumn("key", F.concat_ws(":", "conv_id", "turn"))
    story = t.conversations.select(F.concat_ws(":", F.lit("story"), "conv_id", "turn").alias("doc_id"), "text")
    found = coding.retrieve_context(
        df, story, "key", "text", ["turn"], ["conv_id"],
        lambda d, c: retrieval.embed_hashed(d, c, dim=64), recursive=False, block=3,
    )
    return found.select("key", "rank", F.round("distance", 6).alias("distance"))


@query("retrieve_passages")
def retrieve_passages(t):
    """Passages of all documents nearest to each message with its history."""
    df = t.conversations.withColumn("key", F.concat_ws(":", "conv_id", "turn"))
    return coding.retrieve_context(
        df, t.documents, "key", "text", ["turn"], ["conv_id"],
        lambda d, c: retrieval.embed_hashed(d, c, dim=64), block=3,
    )
