"""Inputs the given tables lack, derived from them alike by Spark and by SQL.

Labels, raters and runs come from row keys by plain arithmetic, so both engines derive the same
rows from whole tables of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["click", "error", "purchase", "signup", "view"]
NBSP = " "

# column -> (number derived from the key, value per remainder)
MESSY = {
    "discussion_type": (
        "conv_id * 10 + turn",
        ["Imaginative entry", "Imaginative", " Seminar ", "Social, Deliberation",
         "Seminar, Deliberation", None, "Social,Social", "Procedure",
         "Seminar, Social, UX", "Seminar, Deliberation, Social, Other, UX"],
    ),
    "question": (
        "conv_id * 7 + turn",
        ["C-LOT, C-LOT", "C-HOT, C-HOT", "O-HOT, C-LOT", "C-LOT? C-HOT?", "O-COT", "?", NBSP, None,
         "C-LOT", "O-HOT"],
    ),
    "pivot": (
        "conv_id * 3 + turn",
        ["Delibration to Seminar", "Deliberationa to Seminar", "Socal to Seminar", "A to B to C",
         "Seminar", "  ", None, "Imaginative to Other", "?"],
    ),
    "uptake": ("conv_id * 5 + turn", ["Prompt", "?", NBSP, None, "Affirm", "Elaborate"]),
    "dialogic_spell": ("conv_id + turn", ["3", "?", NBSP, " ", None, "12", "x"]),
    "bookclub": (
        "conv_id",
        ["Book Club One", "Book Club Twenty", "Book Club Twenty-One", "Other", None,
         "Book Club Seven"],
    ),
    "course": ("conv_id", ["? F20", "F20", None, "S21"]),
    "is_answer": ("turn", ["No", " ", "", None]),
    "page": ("conv_id + turn", ["?", " ", None, "7", "12"]),
    "time": (
        "conv_id * 3 + turn",
        ["2024-03-01 10:11:12", "bad", None, "2023-12-31 23:59:59", "2024-02-30 00:00:00"],
    ),
}


def sql_text(v: str | None) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(sql_text(v) for v in values) + "]"


def pick(number: Column, values: list) -> Column:
    array = F.array(*[F.lit(v).cast("string") for v in values])
    return F.get(array, (number % len(values)).cast("int"))


def messages(t) -> DataFrame:
    df = t.conversations.select("conv_id", "turn", "role", F.col("text").alias("message"))
    return df.withColumns({c: pick(F.expr(e), v) for c, (e, v) in MESSY.items()})


MESSAGES = (
    "messages AS (SELECT conv_id, turn, role, text AS message, "
    + ", ".join(
        f"{sql_list(v)}[1 + (({e}) % {len(v)})] AS {c}" for c, (e, v) in MESSY.items()
    )
    + " FROM conversations)"
)


def _kind(shift: Column) -> Column:
    """Kind ``shift`` places after the row's own."""
    kinds = F.array(*map(F.lit, KINDS))
    at = F.array_position(kinds, F.col("event_type")).cast("bigint") - 1
    return F.get(kinds, ((at + shift) % len(KINDS)).cast("int"))


def _sql_kind(shift: str) -> str:
    kinds = sql_list(KINDS)
    return f"{kinds}[1 + ((list_position({kinds}, event_type) - 1 + {shift}) % 5)]"


def _shifted(every: int, shift: int) -> Column:
    i = F.col("event_id")
    return (
        F.when(i % 35 == 0, None)
        .when(i % every == 0, _kind(F.lit(shift)))
        .otherwise(F.col("event_type"))
    )


def _sql_shifted(every: int, shift: int) -> str:
    return (
        f"CASE WHEN event_id % 35 = 0 THEN NULL WHEN event_id % {every} = 0 "
        f"THEN {_sql_kind(str(shift))} ELSE event_type END"
    )


def raters(t) -> DataFrame:
    """Three raters per event; the second and third disagree or are missing in places."""
    return t.events.select(
        "event_id",
        "user_id",
        "ts",
        F.col("event_type").alias("r1"),
        _shifted(5, 1).alias("r2"),
        _shifted(7, 2).alias("r3"),
    )


RATERS = (
    "raters AS (SELECT event_id, user_id, ts, event_type AS r1, "
    f"{_sql_shifted(5, 1)} AS r2, {_sql_shifted(7, 2)} AS r3 FROM events)"
)

# run id -> (differs every n events, by how many kinds)
RUNS = {"bert": (4, 1), "llama": (3, 3), "mistral": (6, 2)}


def runs(t) -> DataFrame:
    """Wide predictions: the true kind and one column per run."""
    return t.events.select(
        "event_id",
        F.when(F.col("event_id") % 11 != 0, F.col("event_type")).alias("label"),
        *[_shifted(n, s).alias(r) for r, (n, s) in RUNS.items()],
    )


RUNS_SQL = (
    "runs AS (SELECT event_id, CASE WHEN event_id % 11 != 0 THEN event_type END AS label, "
    + ", ".join(f"{_sql_shifted(n, s)} AS {r}" for r, (n, s) in RUNS.items())
    + " FROM events)"
)


def preds(t) -> DataFrame:
    """Long predictions: (event_id, run_id, label)."""
    cells = F.array(
        *[F.struct(F.lit(r).alias("run_id"), F.col(r).alias("label")) for r in RUNS]
    )
    return runs(t).select("event_id", F.inline(cells))


PREDS = (
    RUNS_SQL
    + ", preds AS ("
    + " UNION ALL ".join(f"SELECT event_id, '{r}' AS run_id, {r} AS label FROM runs" for r in RUNS)
    + ")"
)

# the token and sentence rules, stated in RE2 terms
SP = r"[ \t\n\r\f\x0B\x{A0}]"
TOKENS = r"regexp_extract_all({0}, '[\p{{L}}\p{{M}}\p{{N}}]+|[^\p{{L}}\p{{M}}\p{{N}} \t\n\r\f\x0B\x{{A0}}]')"


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{SP}+|{SP}+$', '', 'g')"


def sql_tokens(x: str) -> str:
    return TOKENS.format(x)


def sql_sentences(x: str) -> str:
    marked = rf"regexp_replace({sql_strip(x)}, '([.!?]){SP}+', '\1' || chr(1), 'g')"
    return f"list_filter(string_split({marked}, chr(1)), lambda s: s != '')"


def sql_blank(x: str) -> str:
    return rf"regexp_full_match({x}, '{SP}+')"
