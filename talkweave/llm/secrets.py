"""Secret scans: patterns propose, decoding and parsing confirm."""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import load, map_texts, pieces
from .pii import listed, of_kind
from .registry import query


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


NAMES = "|".join(map(either_case, ("password", "passwd", "secret", "token"))) + f"|{either_case('api')}_?{either_case('key')}"
ASSIGN = re.compile(rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{32}")
TOKEN = re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:(?!-----)[\s\S])*)-----END \1-----")
BLOB = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{64,}={0,2}")

#: kinds in the order in which spans with one start are listed; the first three are the base
KINDS = ("assign", "access", "hex", "jwt", "pem", "key")
SPAN = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("value", T.StringType()),
        ]
    )
)


def unbase64(text: str) -> bytes | None:
    """Either alphabet, with or without padding; None where it is neither."""
    plain = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def tag_at(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the value of a tag-length-value at ``at``; None if it leaves ``end`` or is not in its shortest form."""
    if at + 2 > end:
        return None
    tag, size, start = data[at], data[at + 1], at + 2
    if size >= 0x80:
        count = size & 0x7F
        if not 1 <= count <= 4 or start + count > end:
            return None
        size, start = int.from_bytes(data[start : start + count], "big"), start + count
        if size < 0x80 or size >> (8 * (count - 1)) == 0:
            return None
    return (tag, start, start + size) if start + size <= end else None


def children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The values between ``start`` and ``end``, which they must fill exactly."""
    out = []
    while start < end:
        item = tag_at(data, start, end)
        if item is None:
            return None
        out.append(item)
        start = item[2]
    return out


def is_der_key(data: bytes) -> bool:
    """A private key in DER: an outer sequence as long as the data, of values that fill it.

    After the version come the RSA or DSA numbers (integers only), an algorithm sequence and an octet string, or an
    octet string alone (elliptic curves).
    """
    outer = tag_at(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    items = children(data, outer[1], outer[2])
    if not items or len(items) < 2 or items[0][0] != 0x02 or items[0][2] - items[0][1] != 1:
        return False
    tags = [t for t, _, _ in items]
    if len(items) >= 6 and all(t == 0x02 for t in tags):
        return all(b > a for _, a, b in items)
    if len(items) >= 3 and tags[1] == 0x30 and tags[2] == 0x04:
        inside = children(data, items[1][1], items[1][2])
        return bool(inside) and inside[0][0] == 0x06
    return tags[1] == 0x04 and items[1][2] - items[1][1] >= 16


def is_ssh_key(data: bytes) -> bool:
    """The OpenSSH form: its magic, three strings and a count, then public keys and the private block, all lengths nested."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False

    def string(at: int) -> int:
        size = int.from_bytes(data[at : at + 4], "big")
        return at + 4 + size if at + 4 <= len(data) and at + 4 + size <= len(data) else -1

    at = len(magic)
    for _ in range(3):
        at = string(at)
        if at < 0:
            return False
    count = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 1 <= count <= 16:
        return False
    for _ in range(count + 1):
        at = string(at)
        if at < 0:
            return False
    return at == len(data)


def is_key(data: bytes | None) -> bool:
    return data is not None and (is_der_key(data) or is_ssh_key(data))


def is_pem(body: str) -> bool:
    """The lines between the marks, less header lines, are a key; an encrypted one is whole cipher blocks.

    Line breaks and slashes may be escaped with backslashes, as in JSON.
    """
    body = re.sub(r"\\+([rn/])", lambda m: "/" if m[1] == "/" else "\n", body)
    lines = [line.strip() for line in body.splitlines()]
    headers = [line for line in lines if ":" in line]
    data = unbase64("".join(line for line in lines if ":" not in line))
    if any("ENCRYPTED" in h for h in headers):
        return bool(data) and len(data) % 8 == 0
    return is_key(data) or is_encrypted(data)


def is_encrypted(data: bytes | None) -> bool:
    """An encrypted key in DER: a sequence of an algorithm sequence and an octet string."""
    outer = tag_at(data, 0, len(data)) if data else None
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    items = children(data, outer[1], outer[2])
    return bool(items) and [t for t, _, _ in items] == [0x30, 0x04]


def is_token(token: str) -> bool:
    """A signed token: its header is a JSON object that names an algorithm, its payload a JSON object."""
    header, payload, _ = token.split(".")
    parts = []
    for part in (header, payload):
        try:
            parts.append(json.loads((unbase64(part) or b"").decode()))
        except (ValueError, RecursionError):
            return False
    return all(isinstance(p, dict) for p in parts) and isinstance(parts[0].get("alg"), str)


def scan(text: str) -> list[tuple[str, int, int, str]]:
    """All spans of one text, by start, then kind."""
    out = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        out += [("assign", m) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [("access", m) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    if "eyJ" in text:
        out += [("jwt", m) for m in TOKEN.finditer(text) if is_token(m[0])]
    if "-----BEGIN" in text:
        out += [("pem", m) for m in PEM.finditer(text) if is_pem(m[2])]
    longest = max(map(len, text.split()), default=0)
    if longest >= 32 and LONG_HEX.search(text):
        out += [("hex", m) for m in HEX.finditer(text) if len(m[0]) >= 32]
    if longest >= 64:
        for m in BLOB.finditer(text):
            plain = re.fullmatch(r"[0-9A-Fa-f]+", m[0])
            if (plain and len(m[0]) % 2 == 0 and is_key(bytes.fromhex(m[0]))) or is_key(unbase64(m[0])):
                out.append(("key", m))
    spans = [(kind, m.start(), m.end(), m[0]) for kind, m in out]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: key and ``spans`` (kind, start, end in code points, value), by start, then kind.

    Assignments, access keys and hex strings are told by form and length. Everything else is reported
    only once decoded and parsed: signed tokens by header and payload, PEM blocks and bare base64 or hex strings by the nested lengths
    of a private key. Each row is worked on where it is read, nothing is shuffled. A null or empty text has no spans; repeated
    rows repeat their result; an empty table gives an empty table.
    """
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("spans", SPAN)])
    names = [f.name for f in SPAN.elementType.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct(list(zip(names, (pa.string(), pa.int32(), pa.int32(), pa.string())))))
        for batch in pieces(batches, 1):
            spans = [[dict(zip(names, s)) for s in scan(t or "")] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["key", "spans"])

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return map_texts(rows, run, schema).select(F.col("key").alias(key), "spans")


@query("op10_secrets")
def op10_secrets(spark, folder):
    found = find_secrets(load(spark, folder, "documents").select("doc_id", "text"))
    base = of_kind(F.col("spans"), *KINDS[:3])
    count = [F.size(of_kind(F.col("spans"), k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return found.select("doc_id", *count, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
