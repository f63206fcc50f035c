"""Raw coded messages to the cleaned table, from operators of this package."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.text import id_with_name
from ..operators import agreement, ordered, rows, schema
from ..operators.blocks import AUTO, Block
from ..operators.joins import stack_sources

# Respelling of labels, groups a pivot may name, classes of questions
TYPE_SPELLING = {"Imaginative entry": "Imaginative Entry", "Imaginative": "Imaginative Entry"}
PIVOT_SPELLING = {
    "Imaginative": "Imaginative Entry",
    "Imaginative entry": "Imaginative Entry",
    "Delibration": "Deliberation",
    "Deliberationa": "Deliberation",
    "Deliberation/Social/Procedure/UX": "Social/Procedure/UX",
    "Socal": "Social/Procedure/UX",
}
PIVOT_GROUPS = {
    "Imaginative Entry": "Imaginative Entry",
    "Deliberation": "Deliberation",
    "Social": "Social/Procedure/UX",
    "Procedure": "Social/Procedure/UX",
    "UX": "Social/Procedure/UX",
    "Seminar": "Seminar",
    "Other": "Other",
}
QUESTION_CLASSES = ("C-HOT", "O-HOT", "C-LOT", "O-LOT")
CLASS_NAMES = {
    "discussion_type": "Discussion",
    "dialogic_spell": "Dialogic Spell",
    "uptake": "Uptake",
    "question": "Question",
    "pivot": "Pivot",
}


def two_rater_source(df: DataFrame, names: Mapping[str, str], drop: Sequence[str] = ()) -> DataFrame:
    """First kind of source: keep the second rater, drop copied and listed columns, rename."""
    kept = schema.drop_prefixed(df, ["R1", "Binary"])
    kept = schema.select_columns(schema.drop_equal_columns(kept), drop=drop)
    return schema.rename(kept, names)


def many_rater_source(
    df: DataFrame, names: Mapping[str, str], drop: Sequence[str] = (), drop_last: int = 0,
    order: Sequence[str] = (), raters: Sequence[str] = (), drop_prefixes: Sequence[str] = ("Unnamed",),
) -> DataFrame:
    """Second kind of source: vote over the ``raters`` (column prefixes), build the pseudonym, drop the tail, rename."""
    kept = schema.drop_prefixed(df, drop_prefixes)
    for label in ("Discussion Type", "Uptake"):
        kept = agreement.majority_label(kept, [f"{r} {label}" for r in raters], label)
    if drop_last:
        kept = rows.drop_tail(kept, drop_last, order)
    kept = kept.withColumn("Pseudonym", id_with_name("User ID", "Name"))
    return schema.rename(schema.select_columns(kept, drop=["User ID", "Name", *drop]), names)


def clean_messages(
    df: DataFrame,
    order: Sequence[str],
    within: Sequence[str],
    block: Block = AUTO,
    class_names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scalar repair, multi-label rows, pivots; missing labels stay NULL.

    Rows gain ``type_part`` and ``question_part``, which follow ``order`` as sort keys, and
    ``pivot_check``. Everything up to the pivot check is row-local.
    """
    have = set(df.columns)
    df = rows.keep_prefix(df, "bookclub", "Book").withColumn("bookclub", L.number_word("bookclub"))
    scalar = {
        "course": L.strip_marker,
        "is_answer": L.is_answer,
        "page": L.blank_to_null,
        "response_number": lambda c: L.blank_to_null(c, extra=()),
    }
    df = df.withColumns({c: f(c) for c, f in scalar.items() if c in have})
    df = rows.split_multilabel(
        df, "discussion_type", divide_also=["question"], take_last_of=["pivot"], change_to="Other",
        part="type_part",
    )
    df = df.withColumns(
        {
            "discussion_type": L.remap("discussion_type", TYPE_SPELLING),
            "dialogic_spell": L.blank_to_null("dialogic_spell").try_cast("int"),
            "uptake": L.blank_to_null("uptake"),
        }
    )
    df = rows.split_multilabel(df, "question", take_last_of=["pivot"], part="question_part")
    start, end = L.pivot_ends("pivot", PIVOT_SPELLING)
    df = df.withColumns(
        {
            "question": L.allow_list("question", QUESTION_CLASSES, other=None),
            "from_pivot": start,
            "to_pivot": end,
        }
    )
    df = ordered.check_pivot(
        df, "discussion_type", "from_pivot", "to_pivot",
        [*order, "type_part", "question_part"], within, PIVOT_GROUPS, block=block,
    )
    # NULL unless both ends are known
    text = F.concat(F.lit("from "), F.col("from_pivot"), F.lit(" to "), F.col("to_pivot"))
    df = df.withColumn("pivot", text).drop("from_pivot", "to_pivot", "guess_from", "guess_to")
    return schema.rename(df, CLASS_NAMES if class_names is None else class_names)


def combined(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both sources as one table with a ``source`` column to keep their rows apart."""
    return stack_sources(first.withColumn("source", F.lit(1)), second.withColumn("source", F.lit(2)))
