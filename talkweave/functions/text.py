"""Text expressions. Everything here is Column -> Column and stays inside codegen."""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as one class, with the no-break space that plain \s leaves out.
SPACE = r"[ \t\n\r\f\x0B\x{A0}]"
# A word is a run of letters, marks and digits; any other visible character stands alone.
WORD_CHAR = r"\p{L}\p{M}\p{N}"
TOKEN = rf"[{WORD_CHAR}]+|[^{WORD_CHAR} \t\n\r\f\x0B\x{{A0}}]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), rf"\A{SPACE}+|{SPACE}+\z", "")


def is_blank(c: Column | str) -> Column:
    """Whitespace only; the empty string is not blank, NULL stays NULL."""
    return _col(c).rlike(rf"\A{SPACE}+\z")


def sentences(c: Column | str) -> Column:
    """Break after . ! or ? followed by whitespace. No abbreviation list."""
    parts = F.split(strip(c), rf"(?<=[.!?]){SPACE}+")
    return F.filter(parts, lambda s: s != "")


def tokens(c: Column | str) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(TOKEN), F.lit(0))


def words(c: Column | str, shortest: int = 1) -> Column:
    """The word tokens alone, lower-cased, of at least ``shortest`` characters.

    Taken from the text directly, which spares a test per token.
    """
    pattern = rf"[{WORD_CHAR}]{{{shortest},}}"
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(pattern), F.lit(0))


def clean_token_array(
    c: Column | str, stop_words: Sequence[str] = (), alphabetic_only: bool = False
) -> Column:
    out = tokens(F.lower(_col(c)))
    if alphabetic_only:
        out = F.filter(out, lambda t: t.rlike(r"\A\p{L}+\z"))
    if stop_words:
        # isin over literals becomes one hash-set probe per token
        out = F.filter(out, lambda t: ~t.isin(*stop_words))
    return out


def clean_tokens(
    c: Column | str, stop_words: Sequence[str] = (), alphabetic_only: bool = False
) -> Column:
    """Lower-cased tokens joined by a blank, optionally without stop words or non-letters."""
    return F.array_join(clean_token_array(c, stop_words, alphabetic_only), " ")


def normalise_text(c: Column | str) -> Column:
    """Lower case, alphabetic tokens only. No spelling, lemma or stem step."""
    return clean_tokens(c, alphabetic_only=True)


def combine_fields(columns: Sequence[Column | str], sep: str = ": ") -> Column:
    """Non-null values as text, joined by ``sep``; missing values are skipped."""
    return F.concat_ws(sep, *[_col(c).cast("string") for c in columns])


def id_with_name(ident: Column | str, name: Column | str) -> Column:
    """``id (name)``; NULL if either part is NULL."""
    return F.concat(_col(ident).cast("string"), F.lit(" ("), _col(name), F.lit(")"))


def length_bucket(n: Column | str, cap: int = 512) -> Column:
    """Next power of two >= n, at most ``cap``."""
    n = _col(n).cast("bigint")
    bits = F.length(F.bin(n - 1))
    power = F.when(n <= 1, F.lit(1)).otherwise(F.pow(F.lit(2.0), bits))
    return F.least(F.lit(cap).cast("bigint"), power.cast("bigint"))


def retrieval_query(history: Column | str, text: Column | str) -> Column:
    """Earlier lines and the new line, one per row."""
    return F.concat_ws("\n", _col(history), _col(text))


def html_title(c: Column | str) -> Column:
    return _unescape(F.regexp_extract(_col(c), r"(?is)<title[^>]*>(.*?)</title>", 1))


def html_text(c: Column | str) -> Column:
    """Visible text: scripts, styles and comments dropped, tags to blanks, spaces squeezed."""
    out = F.regexp_replace(_col(c), r"(?is)<script\b.*?</script>", " ")
    out = F.regexp_replace(out, r"(?is)<style\b.*?</style>", " ")
    out = F.regexp_replace(out, r"(?s)<!--.*?-->", " ")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", " ")
    return strip(F.regexp_replace(_unescape(out), f"{SPACE}+", " "))


#: a character reference: decimal, hexadecimal, or by name
ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
#: names and what they stand for, from the language's own table of the HTML standard
ENTITY_NAMES = {f"&{name};": chr(point) for name, point in (*name2codepoint.items(), ("apos", 39))}


def _unescape(c: Column) -> Column:
    """Character references decoded once, left to right; unknown names stay as they are.

    Numbers that are no characters become U+FFFD. ``c`` is named once, as the only element of an array: what it says is computed once for all uses.
    """
    names = F.create_map(*[F.lit(x) for pair in ENTITY_NAMES.items() for x in pair])

    def decoded(entity: Column) -> Column:
        digits = F.regexp_extract(entity, r"^&#[xX]?([0-9a-fA-F]+);$", 1)
        point = F.when(entity.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")
        real = (point > 0) & (point < 0x110000) & ~point.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(real, point).otherwise(0xFFFD)), 8, "0")), "UTF-32")
        return F.when(entity.startswith("&#"), char).otherwise(F.coalesce(F.try_element_at(names, entity), entity))

    def joined(text: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
        parts = F.arrays_zip(F.split(text, ENTITY, -1).alias("gap"), found.alias("entity"))
        pieces = F.transform(parts, lambda p: F.concat(p["gap"], F.when(p["entity"].isNull(), "").otherwise(decoded(p["entity"]))))
        return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)

    return F.get(F.transform(F.array(c), joined), F.lit(0))
