"""Label and scalar repair expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, is_blank, strip

NO_LABEL = "None"
UNKNOWN_MARKS = ("?",)

_UNITS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen "
    "fourteen fifteen sixteen seventeen eighteen nineteen"
).split()
_TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
_WORD_VALUE = {w: i for i, w in enumerate(_UNITS)} | {w: 10 * i for i, w in enumerate(_TENS, 2)}


def literal_map(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def number_word(c: Column | str) -> Column:
    """Number named by the last word (``Book Club Twenty-One`` -> 21), zero to ninety-nine."""
    last = F.lower(F.element_at(F.split(_col(c), " "), -1))
    values = literal_map(_WORD_VALUE)
    return F.aggregate(
        F.split(last, "-"), F.lit(0), lambda acc, w: acc + F.try_element_at(values, w)
    ).cast("int")


def blank_to_null(c: Column | str, extra: Sequence[str] = UNKNOWN_MARKS) -> Column:
    c = _col(c)
    return F.when(~(c.isin(*extra) | is_blank(c)), c)


def blank_to_none_label(c: Column | str, extra: Sequence[str] = UNKNOWN_MARKS) -> Column:
    return F.coalesce(blank_to_null(c, extra), F.lit(NO_LABEL))


def is_answer(c: Column | str) -> Column:
    """True for NULL or whitespace, false for everything else (also '')."""
    return F.coalesce(is_blank(c), F.lit(True))


def strip_marker(c: Column | str) -> Column:
    """Drop the first two characters when the first is a question mark."""
    c = _col(c)
    return F.when(c.startswith("?"), F.substring(c, 3, 1 << 30)).otherwise(c)


def remap(c: Column | str, mapping: Mapping[str, str | None], trim: bool = True) -> Column:
    """Replace listed values, keep the others. A ``None`` target gives NULL.

    Trims after replacing, so a padded spelling is only replaced if listed padded.
    For a mapping that is a table use :func:`talkweave.operators.joins.lookup`.
    """
    c = _col(c)
    to_null = [k for k, v in mapping.items() if v is None]
    known = {k: v for k, v in mapping.items() if v is not None}
    out = F.coalesce(F.try_element_at(literal_map(known), c), c) if known else c
    if to_null:
        out = F.when(~c.isin(*to_null), out)
    return strip(out) if trim else out


def allow_list(c: Column | str, allowed: Sequence[str], other: str | None = NO_LABEL) -> Column:
    c = _col(c)
    return F.when(c.isin(*allowed), c).otherwise(F.lit(other))


def as_class(c: Column | str) -> Column:
    """The one place where a missing label becomes a class of its own."""
    return F.coalesce(_col(c).cast("string"), F.lit(NO_LABEL))


def backfill(primary: Column | str, other: Column | str) -> Column:
    """``primary`` unless NULL or empty, else ``other``."""
    return F.coalesce(F.nullif(_col(primary), F.lit("")), _col(other))


def parse_time(c: Column | str, fmt: str | None = None, lenient: bool = True) -> Column:
    """Text to timestamp: NULL for bad input when lenient, an error otherwise."""
    c = _col(c)
    args = (c,) if fmt is None else (c, F.lit(fmt))
    if lenient:
        return F.try_to_timestamp(*args)
    return F.to_timestamp(c, fmt) if fmt else F.to_timestamp(c)


TIME_PARTS = ("minute", "hour", "day", "month", "year", "second", "date")


def time_parts(c: Column | str, parts: Sequence[str] = TIME_PARTS) -> list[Column]:
    c = _col(c)
    make = {
        "minute": F.minute,
        "hour": F.hour,
        "day": F.dayofmonth,
        "month": F.month,
        "year": F.year,
        "second": F.second,
        "date": F.to_date,
    }
    return [make[p](c).alias(p) for p in parts]


# --- pivots -----------------------------------------------------------------


def pivot_ends(c: Column | str, fixes: Mapping[str, str] | None = None) -> tuple[Column, Column]:
    """(from, to) of ``A to B``; both NULL when blank or with more than two parts.

    A value without `` to `` keeps its text as the start and has no end.
    """
    c = blank_to_null(c)
    parts = F.split(c, " to ")
    parts = F.when(F.size(parts) <= 2, parts)
    ends = []
    for i in (1, 2):
        end = strip(F.try_element_at(parts, F.lit(i)))
        ends.append(remap(end, fixes, trim=False) if fixes else end)
    return ends[0], ends[1]


def pivot_text(start: Column, end: Column) -> Column:
    return F.coalesce(
        F.concat(F.lit("from "), start, F.lit(" to "), end), F.lit(NO_LABEL)
    )


# --- generated text -> label ------------------------------------------------


def find_first(
    c: Column | str, classes: Sequence[str], whole_word: bool = False, default: str = NO_LABEL, ignore_case: bool = True
) -> Column:
    """Class named earliest in the text; list order on ties; ``default`` if none is named.

    Letter case does not count unless ``ignore_case`` is off; the class is returned as listed.
    """
    c = F.lower(_col(c)) if ignore_case else _col(c)
    ranked = list(classes) + ([default] if default not in classes else [])
    found = []
    for i, name in enumerate(ranked):
        wanted = name.lower() if ignore_case else name
        if whole_word:
            edge = r"[\p{L}\p{N}]"
            at = F.regexp_instr(c, F.lit(rf"(?<!{edge})\Q{wanted}\E(?!{edge})"))
        else:
            at = F.locate(wanted, c)
        found.append(
            F.struct(
                (at == 0).alias("missing"), at.alias("at"), F.lit(i).alias("rank"), F.lit(name).alias("name")
            )
        )
    # the least struct; plain expressions, so all of it is compiled and c is computed once
    first = F.least(*found) if len(found) > 1 else found[0]
    return F.when(~first["missing"], first["name"]).otherwise(default)  # also for a NULL text


def parse_delimited(
    c: Column | str,
    classes: Sequence[str],
    mark: str = "//",
    missing: str = "Not Found",
) -> Column:
    """Text after ``mark``; without it the last listed class the text contains."""
    c = _col(c)
    after = strip(F.get(F.split(c, rf"\Q{mark}\E"), F.lit(1)))
    named = F.filter(F.array(*[F.lit(x) for x in classes]), lambda x: F.contains(c, x))
    return F.coalesce(after, F.try_element_at(named, F.lit(-1)), F.lit(missing))


def argmax_label(scores: Column | str, classes: Sequence[str]) -> Column:
    """Class of the highest score in an array aligned with ``classes``; first on ties."""
    names = F.array(*[F.lit(x) for x in classes])
    ranked = F.transform(
        _col(scores),
        lambda s, i: F.struct(s.alias("score"), (-i).alias("back"), F.get(names, i).alias("name")),
    )
    return F.array_max(ranked)["name"]


def one_hot(c: Column | str, classes: Sequence[str]) -> Column:
    c = _col(c)
    return F.array(*[F.coalesce((c == k).cast("int"), F.lit(0)) for k in classes])


def row_mode(columns: Sequence[Column | str]) -> Column:
    """Most frequent non-null value across a row's columns; smallest on ties; NULL if all are.

    Counts inside the row, so many raters cost no shuffle.
    """
    votes = F.array_compact(F.array(*[_col(c) for c in columns]))
    counted = F.transform(
        F.array_distinct(votes),
        lambda v: F.struct(
            (-F.size(F.filter(votes, lambda w: w == v))).alias("n"), v.alias("label")
        ),
    )
    return F.array_min(counted)["label"]
