"""L: prompts."""

from pyspark.sql import functions as F

from ..functions import wording as W
from ..operators import ordered as O
from ..operators import prompts as P
from ..operators.explore import first_n_per_class
from ..operators.joins import attach_context
from ..sources.codebook import read_codebook
from .derive import MESSAGES, RUNS, RUNS_SQL, messages, runs, sql_text
from .registry import query
from .sources import CODEBOOK, raw_codebook

NL = "chr(10)"


def lit(text: str) -> str:
    """SQL for a text with line breaks."""
    return "(" + f" || {NL} || ".join(sql_text(x) for x in text.split("\n")) + ")"


_ENTRY = f"""'### Class: ' || term || ' ###' || {NL}
    || coalesce('### Definition: ' || replace(definition, {NL}, ' ') || ' ###' || {NL}, '')
    || coalesce('### Example: ' || replace(example, {NL}, ' ') || ' ###' || {NL}, '')"""
_BLOCKS = f"""{CODEBOOK}, blocks AS (
    SELECT class, string_agg({_ENTRY}, {NL} ORDER BY term) AS block,
           string_agg(term, ', ' ORDER BY term) AS classes FROM codebook GROUP BY class)"""


@query("codebook_block", f"WITH {_BLOCKS} SELECT * FROM blocks")
def codebook_block(t):
    blocks = P.codebook_block(read_codebook(raw_codebook(t)))
    return blocks.withColumn("classes", F.array_join("classes", ", "))


# prompts over conversations: a short codebook of the roles, history of four turns with the role
# as its label, the first two turns of the conversation as passages
def role_codebook(t):
    """The roles that occur, each defined by how often, as a codebook table."""
    counts = t.conversations.groupBy("role").agg(F.count("*").alias("n"))
    return counts.select(
        F.lit("Role").alias("class"),
        F.col("role").alias("term"),
        F.concat(F.col("n").cast("string"), F.lit("\nturns")).alias("definition"),
        F.lit(None).cast("string").alias("example"),
    )


def _prompts(t, style, past_labels, with_context=False, use_history=True):
    blocks = P.codebook_block(role_codebook(t))
    df = t.conversations
    df = O.history(df, "text", ["turn"], ["conv_id"], k=4, label="role", block=3)
    if with_context:
        passages = t.conversations.select("conv_id", (F.col("turn") + 1).alias("rank"), "text")
        df = attach_context(df, passages, key="conv_id")
    return P.build_prompts(
        df,
        "text",
        blocks.select("block").scalar(),
        blocks.select("classes").scalar(),
        style=style,
        use_history=use_history,
        use_past_labels=past_labels,
        context="context" if with_context else None,
    )


def shown(prompt="prompt"):
    return F.array_join(
        F.transform(prompt, lambda m: F.concat(m["role"], F.lit("> "), m["content"])), "\n---\n"
    )


SEP = f"{NL} || '---' || {NL}"
_ROLES = f"""roles AS (
    SELECT string_agg('### Class: ' || role || ' ###' || {NL} || '### Definition: ' || n || ' turns ###' || {NL},
                      {NL} ORDER BY role) AS block, string_agg(role, ', ' ORDER BY role) AS classes
    FROM (SELECT role, count(*) AS n FROM conversations GROUP BY role))"""
_HIST = f"""hist AS (
    SELECT conv_id, turn, role, text,
       coalesce(array_to_string(list('user> ' || text || {SEP} || 'assistant> Class: ' || role) OVER w, {SEP}) || {SEP}, '') AS labelled,
       coalesce(array_to_string(list('user> ' || text) OVER w, {SEP}) || {SEP}, '') AS plain,
       coalesce(array_to_string(list(text) OVER w, {NL}), '') AS lines
    FROM conversations
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING))"""
_CTX = f"""ctx AS (SELECT conv_id, string_agg({NL} || text, '' ORDER BY turn) AS docs
    FROM conversations WHERE turn < 2 GROUP BY conv_id)"""


def _system(context=False, history=True):
    out = lit(W.ROLE)
    if context:
        out += f" || {lit(chr(10) + W.CONTEXT)} || coalesce(ctx.docs, '')"
    out += f" || {lit(chr(10) + W.CODEBOOK_OPEN)} || block || {lit(W.CODEBOOK_CLOSE + W.CLASSES_OPEN)}"
    out += f" || classes || {lit(W.CLASSES_CLOSE + W.OTHERWISE)}"
    if history:
        out += f" || {lit(chr(10) + W.HISTORY)}"
    return out


_READY = f"{SEP} || 'assistant> ' || {sql_text(W.READY)} || {SEP}"


@query(
    "build_prompts",
    f"""WITH {_ROLES}, {_HIST}
        SELECT conv_id, turn, 'system> ' || {_system()} || {SEP} || labelled || 'user> ' || text AS prompt
        FROM hist, roles""",
)
def build_prompts(t):
    return _prompts(t, "system", True).select("conv_id", "turn", shown().alias("prompt"))


@query(
    "build_prompts_unlabelled",
    f"""WITH {_ROLES}, {_HIST}
        SELECT conv_id, turn, 'system> ' || {_system()} || {SEP} || plain || 'user> ' || text AS prompt
        FROM hist, roles""",
)
def build_prompts_unlabelled(t):
    return _prompts(t, "system", False).select("conv_id", "turn", shown().alias("prompt"))


@query(
    "build_prompts_user_style",
    f"""WITH {_ROLES}, {_HIST}, {_CTX}
        SELECT conv_id, turn, 'user> ' || {_system(context=True)} || {NL} || lines || {_READY} || 'user> ' || text AS prompt
        FROM hist LEFT JOIN ctx USING (conv_id), roles""",
)
def build_prompts_user_style(t):
    done = _prompts(t, "user", False, with_context=True)
    return done.select("conv_id", "turn", shown().alias("prompt"))


@query(
    "build_prompts_no_history",
    f"""WITH {_ROLES}, {_HIST}
        SELECT conv_id, turn, 'user> ' || {_system(history=False)} || {_READY} || 'user> ' || text AS prompt
        FROM hist, roles""",
)
def build_prompts_no_history(t):
    done = _prompts(t, "user", False, use_history=False)
    return done.select("conv_id", "turn", shown().alias("prompt"))


TEMPLATE = {
    "begin": "<s>",
    "roles": {
        "system": ("[SYS]", "[/SYS]"),
        "user": ("[INST]", "[/INST]"),
        "assistant": ("", "</s>"),
    },
    "generate": "[ANSWER]",
}


@query(
    "render_chat",
    f"""WITH {_HIST}
        SELECT conv_id, turn, '<s>[INST]' || text || '[/INST]Class: ' || role || '<end>' AS train_text,
               '<s>[INST]' || text || '[/INST][ANSWER]' AS test_text FROM hist""",
)
def render_chat(t):
    prompt = F.array(P.turn("user", F.col("text"))).cast(P.MESSAGES)
    return t.conversations.select(
        "conv_id",
        "turn",
        P.render_chat(P.with_answer(prompt, "role"), TEMPLATE, eos=("</s>", "<end>")).alias("train_text"),
        P.render_chat(prompt, TEMPLATE, generate=True).alias("test_text"),
    )


def _event_prompts(t):
    opening = F.concat(F.lit("First line.\nSecond line about "), F.col("props"))
    prompt = F.array(P.turn("system", opening), P.turn("user", F.col("event_type"))).cast(P.MESSAGES)
    return t.events.select("event_id", prompt.alias("prompt"))


_EXPERTS = " || ".join(
    f"'Expert {r} categorized the sentence as class: ' || coalesce({r}, 'None') || '.' || {NL}" for r in RUNS
)


@query(
    "ensemble_prompt",
    f"""WITH {RUNS_SQL}
        SELECT event_id, 'system> ' || {lit(W.ENSEMBLE_ROLE)} || 'Second line about ' || props || {SEP}
               || 'user> ' || event_type || {SEP} || 'assistant> ' || {sql_text(W.ENSEMBLE_ASK)} || {SEP}
               || 'user> ' || {lit(W.ENSEMBLE_OPEN)} || {_EXPERTS} || {lit(W.ENSEMBLE_CLOSE)} AS prompt
        FROM events JOIN runs USING (event_id)""",
)
def ensemble_prompt(t):
    df = _event_prompts(t).join(runs(t), "event_id")
    return df.select("event_id", shown(P.ensemble_prompt("prompt", list(RUNS))).alias("prompt"))


@query(
    "explain_prompt",
    f"""SELECT event_id, 'system> First line.' || {NL} || 'Second line about ' || props || {SEP}
               || 'user> ' || event_type || {SEP} || 'assistant> Class: Seminar' || {SEP}
               || 'user> ' || {sql_text(W.EXPLAIN)} AS prompt FROM events""",
)
def explain_prompt(t):
    asked = P.explain_prompt("prompt", F.lit("Seminar"))
    return _event_prompts(t).select("event_id", shown(asked).alias("prompt"))


@query(
    "fewshot_block",
    f"""WITH {MESSAGES}, r AS (
          SELECT message, coalesce(uptake, 'NaN') AS uptake, row_number() OVER (
                   PARTITION BY coalesce(uptake, 'NaN') ORDER BY conv_id, turn) AS rank FROM messages)
        SELECT string_agg({NL} || {NL} || message || ' // ' || uptake, '' ORDER BY uptake, rank) AS examples
        FROM r WHERE rank <= 5""",
)
def fewshot_block(t):
    df = messages(t).select("conv_id", "turn", "message", "uptake")
    first = first_n_per_class(df, "uptake", ["conv_id", "turn"], 5)
    return P.fewshot_block(first, "message", "uptake", ["uptake", "rank"])
