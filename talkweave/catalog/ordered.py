"""E: ordered windows. Posts are ``events`` (user = source, ts = order) or ``conversations``.

Blocks are cut by 3 turns and by one day of events, far narrower than any job would need, so
that groups span blocks in tables of any size.
"""

from pyspark.sql import functions as F

from ..functions.labels import literal_map, pivot_ends, pivot_text
from ..operators import ordered as O
from .derive import MESSAGES, messages, sql_blank
from .registry import query

TURNS = 3
EVENT_SPAN = 86_400


@query(
    "prev_message",
    """SELECT conv_id, turn,
              coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '') AS prev_message
       FROM conversations""",
)
def prev_message(t):
    df = t.conversations.select("conv_id", "turn", "text")
    return O.prev_message(df, "text", ["turn"], ["conv_id"], block=TURNS).drop("text")


# events as posts: the user is the source file, ts the order; value bands repeat and are NULL in
# places, so runs break, return and hold NULL keys
_POSTS = """posts AS (
    SELECT event_id, user_id, ts, event_type, props,
           CASE WHEN event_id % 9 > 0 THEN event_type END AS uptake,
           CASE WHEN value < 5 THEN 'low' WHEN value < 15 THEN 'high' END AS band
    FROM events)"""
_RUNS = (
    _POSTS
    + """, flagged AS (
    SELECT *, CASE WHEN lag(event_id) OVER w IS NULL OR band IS DISTINCT FROM lag(band) OVER w
                   THEN 1 ELSE 0 END AS start
    FROM posts WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  numbered AS (
    SELECT *, CAST(sum(start) OVER (PARTITION BY user_id ORDER BY ts, event_id
                               ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run
    FROM flagged)"""
)
ORDER = ["ts", "event_id"]
USER = ["user_id"]


def _posts(t):
    return t.events.select(
        "event_id",
        "user_id",
        "ts",
        "event_type",
        "props",
        F.when(F.col("event_id") % 9 > 0, F.col("event_type")).alias("uptake"),
        F.when(F.col("value") < 5, "low").when(F.col("value") < 15, "high").alias("band"),
    )


@query("conversation_runs", f"WITH {_RUNS} SELECT event_id, user_id, run FROM numbered")
def conversation_runs(t):
    df = _posts(t).select("event_id", "user_id", "ts", "band")
    done = O.conversation_runs(df, ["band"], ORDER, USER, block=EVENT_SPAN)
    return done.select("event_id", "user_id", "run")


@query(
    "history",
    """SELECT conv_id, turn,
              coalesce(array_to_string(list(text) OVER (PARTITION BY conv_id ORDER BY turn
                                ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), chr(10)), '') AS history
       FROM conversations""",
)
def history(t):
    df = t.conversations.select("conv_id", "turn", "text")
    done = O.history(df, "text", ["turn"], ["conv_id"], k=6, block=TURNS)
    lines = F.array_join(F.transform("history", lambda h: h["text"]), "\n")
    return done.select("conv_id", "turn", lines.alias("history"))


@query(
    "label_history",
    f"""WITH {_RUNS}
        SELECT event_id,
               coalesce(array_to_string(list(props || '=' || coalesce(uptake, 'none')) OVER
                 (PARTITION BY user_id, run ORDER BY ts, event_id
                  ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), ','), '') AS history
        FROM numbered""",
)
def label_history(t):
    """Texts with aligned labels, within runs of one value band; missing labels keep their place."""
    done = O.label_history(_posts(t), "props", "uptake", ORDER, USER, k=4, run_keys=["band"], block=EVENT_SPAN)
    pair = F.transform(
        "history", lambda h: F.concat(h["text"], F.lit("="), F.coalesce(h["label"], F.lit("none")))
    )
    return done.select("event_id", F.array_join(pair, ",").alias("history"))


@query(
    "prev_categories",
    f"""WITH {_RUNS}
        SELECT event_id,
               coalesce(array_to_string(list(event_type || '-' || coalesce(uptake, '') || '-' || user_id) OVER
                 (PARTITION BY user_id, run ORDER BY ts, event_id
                  ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), '|'), '') AS prev_categories
        FROM numbered""",
)
def prev_categories(t):
    parts = ["event_type", "uptake", "user_id"]
    done = O.prev_categories(_posts(t), parts, ORDER, USER, run_keys=["band"], block=EVENT_SPAN)
    return done.select("event_id", "prev_categories")


FIXES = {
    "Imaginative": "Imaginative Entry",
    "Delibration": "Deliberation",
    "Deliberationa": "Deliberation",
    "Socal": "Social/Procedure/UX",
}
_FIX = "coalesce(map {" + ", ".join(f"'{a}': '{b}'" for a, b in FIXES.items()) + "}[{x}], {x})"


def _fixed(x):
    return _FIX.replace("{x}", x)


@query(
    "parse_pivot",
    f"""WITH {MESSAGES},
        p AS (SELECT conv_id, turn, CASE WHEN "pivot" = '?' OR {sql_blank('"pivot"')} THEN NULL
                     ELSE string_split("pivot", ' to ') END AS parts FROM messages),
        e AS (SELECT conv_id, turn, CASE WHEN len(parts) <= 2 THEN {_fixed('parts[1]')} END AS from_pivot,
                     CASE WHEN len(parts) <= 2 THEN {_fixed('parts[2]')} END AS to_pivot FROM p)
        SELECT *, coalesce('from ' || from_pivot || ' to ' || to_pivot, 'None') AS pivot FROM e""",
)
def parse_pivot(t):
    start, end = pivot_ends("pivot", FIXES)
    return messages(t).select(
        "conv_id",
        "turn",
        start.alias("from_pivot"),
        end.alias("to_pivot"),
        pivot_text(start, end).alias("pivot"),
    )


# coded pivots: right on some rows, wrong on others, absent on the rest; 'error' has no group
COLLAPSE = {"click": "use", "view": "use", "signup": "join", "purchase": "buy"}
_GROUP = "map {" + ", ".join(f"'{a}': '{b}'" for a, b in COLLAPSE.items()) + "}"
_CODED = f"""coded AS (
    SELECT event_id, user_id, ts, event_type,
           CASE event_id % 4 WHEN 0 THEN 'use' WHEN 1 THEN 'buy' WHEN 2 THEN 'join' END AS from_pivot,
           CASE WHEN event_id % 4 < 3 THEN
             CASE WHEN event_id % 5 = 0 THEN 'join' ELSE coalesce({_GROUP}[event_type], 'use') END END AS to_pivot,
           lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
    FROM events),
  guessed AS (
    SELECT *, from_pivot IS NOT NULL AND {_GROUP}[prev] IS NOT NULL AND {_GROUP}[event_type] IS NOT NULL AS known
    FROM coded),
  checked AS (
    SELECT event_id, CASE WHEN known THEN {_GROUP}[prev] END AS guess_from,
           CASE WHEN known THEN {_GROUP}[event_type] END AS guess_to,
           CASE WHEN known THEN
             CASE WHEN from_pivot = {_GROUP}[prev] AND to_pivot = {_GROUP}[event_type]
                  THEN 'corrected' ELSE 'misplaced' END END AS pivot_check
    FROM guessed)"""


def _coded(t):
    i, kind = F.col("event_id"), F.col("event_type")
    right = F.coalesce(F.try_element_at(literal_map(COLLAPSE), kind), F.lit("use"))
    return t.events.select(
        "event_id",
        "user_id",
        "ts",
        "event_type",
        F.when(i % 4 == 0, "use").when(i % 4 == 1, "buy").when(i % 4 == 2, "join").alias("from_pivot"),
        F.when(i % 4 < 3, F.when(i % 5 == 0, "join").otherwise(right)).alias("to_pivot"),
    )


def _checked(t):
    return O.check_pivot(
        _coded(t), "event_type", "from_pivot", "to_pivot", ORDER, USER, COLLAPSE, block=EVENT_SPAN
    )


@query("check_pivot", f"WITH {_CODED} SELECT * FROM checked")
def check_pivot(t):
    return _checked(t).select("event_id", "guess_from", "guess_to", "pivot_check")


@query(
    "pivot_check_summary",
    f"""WITH {_CODED}, n AS (
          SELECT count(*) FILTER (WHERE pivot_check = 'corrected') AS corrected,
                 count(*) FILTER (WHERE pivot_check = 'misplaced') AS misplaced FROM checked)
        SELECT *, round(corrected / (corrected + misplaced), 6) AS share FROM n""",
)
def pivot_check_summary(t):
    return O.pivot_check_summary(_checked(t)).withColumn("share", F.round("share", 6))


@query(
    "check_pivot_contains",
    """SELECT event_id, CASE WHEN event_id % 3 > 0 THEN
                coalesce(contains(p, lag(event_type) OVER w) AND contains(p, event_type), false) END AS pivot_named
       FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN 'click to view'
                            ELSE event_type || ' to ' || event_type END AS p FROM events)
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def check_pivot_contains(t):
    kind = F.col("event_type")
    text = F.when(F.col("event_id") % 2 == 0, "click to view").otherwise(F.concat(kind, F.lit(" to "), kind))
    df = t.events.select(
        "event_id", "user_id", "ts", "event_type", F.when(F.col("event_id") % 3 > 0, text).alias("pivot")
    )
    done = O.check_pivot_contains(df, "event_type", "pivot", ORDER, USER, block=EVENT_SPAN)
    return done.select("event_id", "pivot_named")


@query(
    "derive_pivot",
    f"""WITH {_RUNS}, p AS (
          SELECT event_id, event_type,
                 lag(event_type) OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS prev FROM numbered)
        SELECT event_id, CASE WHEN prev != event_type THEN prev END AS from_pivot,
               CASE WHEN prev != event_type THEN event_type END AS to_pivot FROM p""",
)
def derive_pivot(t):
    done = O.derive_pivot(_posts(t), "event_type", ORDER, USER, run_keys=["band"], block=EVENT_SPAN)
    return done.select("event_id", "from_pivot", "to_pivot")
