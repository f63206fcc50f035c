"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import load
from .registry import query

SPAN = "array<struct<kind:string,start:int,end:int,value:string,score:double>>"


def digits_only(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def has_digits(low: int, high: int) -> Callable[[Column], Column]:
    return lambda value: F.length(digits_only(value)).between(low, high)


def is_ip(value: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return value.rlike(rf"^{part}(?:\.{part}){{3}}$")


def is_card(value: Column) -> Column:
    digits = digits_only(value)
    return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)


def is_iban(value: Column) -> Column:
    """Remainder 1 modulo 97, with the first four characters moved to the end and letters as 10 to 35."""
    plain = F.replace(value, F.lit(" "))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.length(plain).between(15, 34) & (F.aggregate(F.split(turned, ""), F.lit(0), step) == 1)


@dataclass(frozen=True)
class Kind:
    """One sort of personal data. ``hint``: a piece of text that every match holds, looked for first."""

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    base: float
    context: str
    hint: str | None = None
    least: float = 0.0


# Possessive quantifiers and the look-behinds start each run once: the spans are those of the plain patterns, found in one pass
# over a run of any length and without recursion.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda value: F.lit(True), 0.9, r"mail|contact|write to|address", "@",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", is_ip, 0.6, r"\bip\b|host|server|client|login", "."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", is_card, 0.7, r"card|visa|master|amex|credit|debit|pay"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", has_digits(9, 15), 0.6, r"phone|tel|call|mobile|fax|dial", "+"),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}+|(?: [A-Z0-9]{4}){2,7}+(?: [A-Z0-9]{1,3})?+)(?![A-Za-z0-9])",
        is_iban, 0.9, r"iban|account|bank|transfer",
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        lambda value: F.lit(True), 0.3, r"\bssn\b|social security|tax id", "-", least=0.5,
    ),
)

BASE = ("email", "ip", "card", "phone")


def spans_of(text: Column, kind: Kind, reach: int = 40, boost: float = 0.25) -> Column:
    """The confirmed spans of one kind, left to right, in code points.

    The text falls into gaps and matches that alternate; their lengths, summed from the left, are the
    positions. A span's score is the kind's own, raised when a context word stands within ``reach`` characters of it
    in the gap on either side.
    """
    nothing = F.array().cast(SPAN)
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.split(text, kind.pattern, -1)
    after = F.slice(gaps, F.lit(2), F.size(gaps))
    parts = F.arrays_zip(gaps.alias("gap"), found.alias("value"), after.alias("after"))

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["gap"])
        end = start + F.length(part["value"])
        around = F.concat_ws(" ", F.right(part["gap"], F.lit(reach)), F.left(part["after"], F.lit(reach)))
        near = F.lower(around).rlike(kind.context)
        score = F.round(F.least(F.lit(1.0), F.lit(kind.base) + F.when(near, boost).otherwise(0.0)), 3)
        span = F.struct(
            F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), part["value"].alias("value"), score.alias("score")
        )
        good = part["value"].isNotNull() & kind.valid(part["value"])
        more = F.when(good, F.array(span).cast(SPAN)).otherwise(nothing)
        return F.struct(end.alias("at"), F.concat(state["out"], more).alias("out"))

    state = F.struct(F.lit(0).alias("at"), nothing.alias("out"))
    spans = F.aggregate(parts, state, step, lambda s: s["out"])
    if kind.least:
        spans = F.filter(spans, lambda s: s["score"] >= kind.least)
    some = text.rlike(kind.pattern)
    return F.when(F.contains(text, F.lit(kind.hint)) & some if kind.hint else some, spans).otherwise(nothing)


def find_personal(docs: DataFrame, key: str = "doc_id", text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """For each row: key and ``spans``, all confirmed spans by kind in the order of ``kinds``, then by start.

    Patterns work on whole texts, without overlaps within a kind; a match that its checksum or range refuses is dropped and not
    tried again. The context score keeps or drops only kinds that ask for a least score; a checked kind stays
    whatever stands around it. Each row is worked on where it is read, nothing is shuffled. A null or empty text has no
    spans; repeated rows repeat their result; an empty table gives an empty table.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    found = rows.select("key", *[spans_of(F.col("text"), k).alias(k.name) for k in kinds])
    return found.select(F.col("key").alias(key), F.concat(*[F.col(k.name) for k in kinds]).alias("spans"))


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query("op5_pii")
def op5_pii(spark, folder):
    found = find_personal(load(spark, folder, "documents").select("doc_id", "text"))
    base = of_kind(F.col("spans"), *BASE)
    count = [F.size(of_kind(F.col("spans"), k)).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *count, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
