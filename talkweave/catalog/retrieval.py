"""J: chunks, embeddings, nearest passages."""

import numpy as np
from pyspark.sql import functions as F

from ..functions.text import retrieval_query as one_query
from ..operators import ordered as O
from ..operators import retrieval as R
from ..operators import vector_index as V
from ..session import written
from .derive import sql_tokens
from .registry import query

_FIXED = """chunks AS (
    SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, text[i * 470 + 1 : i * 470 + 500] AS chunk
    FROM documents, unnest(range(1 + greatest(length(text) - 31, 0) // 470)) AS u(i)
    WHERE length(text) > 0)"""


@query("chunk_fixed", f"WITH {_FIXED} SELECT * FROM chunks")
def chunk_fixed(t):
    return R.chunk_fixed(t.documents.select("doc_id", "text"), "text")


@query(
    "chunk_recursive",
    r"""WITH d AS (SELECT doc_id, regexp_replace(text, '\s', '', 'g') AS seen FROM documents)
        SELECT doc_id, md5(seen) AS visible, length(seen) AS letters, true AS repeats, true AS in_bounds, true AS found FROM d WHERE seen != ''""",
)
def chunk_recursive(t):
    """Without overlap the chunks must hold every visible character once, in order. With overlap they hold no fewer,
    none is longer than asked, and all are parts of the text."""
    docs = t.documents.select("doc_id", "text")
    seen = F.regexp_replace("chunk", r"\s", "")

    def gathered(overlap, name):
        item = F.struct("chunk_no", seen.alias("seen"), "chunk")
        return R.chunk_recursive(docs, "text", overlap=overlap).groupBy("doc_id").agg(F.array_sort(F.collect_list(item)).alias(name))

    both = docs.join(gathered(0, "plain"), "doc_id").join(gathered(30, "lapped"), "doc_id")
    visible = F.array_join(F.transform("plain", lambda c: c["seen"]), "")
    letters = F.aggregate("lapped", F.lit(0), lambda n, c: n + F.length(c["seen"]))
    return both.select(
        "doc_id",
        F.md5(visible).alias("visible"),
        F.length(visible).cast("bigint").alias("letters"),
        (letters >= F.length(visible)).alias("repeats"),
        F.forall("lapped", lambda c: F.length(c["chunk"]) <= 500).alias("in_bounds"),
        F.forall("lapped", lambda c: F.contains(F.col("text"), c["chunk"])).alias("found"),
    )


@query("chunk_recursive_rows")
def chunk_recursive_rows(t):
    return R.chunk_recursive(t.documents.select("doc_id", "text"), "text")


@query(
    "retrieval_query",
    """SELECT conv_id, turn,
              coalesce(array_to_string(list(text) OVER (PARTITION BY conv_id ORDER BY turn
                 ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), chr(10)) || chr(10), '') || text AS query
       FROM conversations""",
)
def retrieval_query(t):
    done = O.history(t.conversations.drop("role"), "text", ["turn"], ["conv_id"], k=6, block=3)
    lines = F.transform("history", lambda h: h["text"])
    return done.select("conv_id", "turn", one_query(lines, "text").alias("query"))


def letter_encoder():
    """A tiny stand-in for a sentence encoder: shares of the letters a to z, and their number."""

    def encode(texts):
        raw = [(s or "").encode("ascii", "ignore") for s in texts]
        doc = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
        cells = doc * 128 + np.frombuffer(b"".join(raw), dtype=np.uint8)
        counts = np.bincount(cells, minlength=128 * len(raw)).reshape(-1, 128)[:, 97:123]
        total = counts.sum(axis=1, keepdims=True)
        return np.hstack([counts / np.maximum(total, 1), total])

    return encode


_COUNTS = ", ".join(
    f"length(text) - length(replace(text, '{chr(c)}', ''))" for c in range(97, 123)
)


@query(
    "embed",
    f"""WITH c AS (SELECT doc_id, [{_COUNTS}] AS c FROM documents)
        SELECT doc_id, array_to_string(list_transform(c, lambda x: CAST(x AS VARCHAR)), ',') AS letters FROM c""",
)
def embed(t):
    """Letter shares times the number of letters, which must give back the letter counts."""
    done = R.embed(t.documents.select("doc_id", "text"), "text", letter_encoder)
    total = F.get("embedding", F.lit(26)).cast("double")
    shares = F.slice("embedding", 1, 26)
    counts = F.transform(shares, lambda x: F.round(x.cast("double") * total).cast("bigint").cast("string"))
    return done.select("doc_id", F.array_join(counts, ",").alias("letters"))


def _sql_hashed(source, dim):
    """(id, embedding) of a relation (id, text): word counts by md5 bucket at unit length."""
    unit = "coalesce(n[d], 0) / greatest(sqrt(list_sum(list_transform(map_values(n), lambda x: x * x))), 1)"
    return f"""hashed AS (
    SELECT id, list_transform(range({dim}), lambda d: CAST({unit} AS FLOAT)) AS embedding FROM (
      SELECT id, coalesce(map_from_entries(list(struct_pack(k := b, v := c::DOUBLE)) FILTER (WHERE b IS NOT NULL)), MAP {{}}) AS n FROM (
        SELECT id, b, count(*) AS c FROM (
          SELECT id, unnest(CASE WHEN len(w) > 0 THEN list_transform(w, lambda x: CAST('0x' || substr(md5(x), 1, 8) AS BIGINT) % {dim})
                                 ELSE [NULL] END) AS b
          FROM (SELECT id, {sql_tokens('lower(text)')} AS w FROM ({source}))) GROUP BY 1, 2) GROUP BY 1))"""


@query(
    "embed_hashed",
    f"""WITH {_sql_hashed('SELECT doc_id AS id, text FROM documents', 256)}
        SELECT id AS doc_id, array_to_string(list_transform(embedding, lambda x: CAST(CAST(round(x * 1e5) AS BIGINT) AS VARCHAR)), ',') AS embedding
        FROM hashed""",
)
def embed_hashed(t):
    done = R.embed_hashed(t.documents.select("doc_id", "text"), "text")
    digits = F.transform("embedding", lambda x: F.round(x.cast("double") * 1e5).cast("bigint").cast("string"))
    return done.select("doc_id", F.array_join(digits, ",").alias("embedding"))


def _sides(t):
    """Every vector asks, all answer."""
    v = t.embeddings
    return v.select(F.col("vec_id").alias("query_id"), "embedding"), v.select("vec_id", "embedding")


def _indexed_sides(t):
    """Every fiftieth vector asks, all answer."""
    asked, vectors = _sides(t)
    return asked.filter(F.col("query_id") % 50 == 0), vectors


def _sql_top(distance, asks="true"):
    return f"""found AS (
    SELECT q.vec_id AS query_id, v.vec_id, {distance} AS d,
           CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY {distance}, v.vec_id) AS INTEGER) AS rank
    FROM embeddings q JOIN embeddings v ON {asks}
    QUALIFY rank <= 5)"""


_L2 = "list_distance(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[]))"
_COS = "list_cosine_distance(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[]))"


@query("top_k", f"WITH {_sql_top(_L2)} SELECT query_id, rank, vec_id, round(d, 6) AS distance FROM found")
def top_k(t):
    """Every vector against all; the answers are broadcast if they are few enough."""
    return R.top_k(*_sides(t)).withColumn("distance", F.round("distance", 6))


@query(
    "top_k_cosine",
    f"WITH {_sql_top(_COS)} SELECT query_id, rank, vec_id, round(d, 6) AS distance FROM found",
)
def top_k_cosine(t):
    return R.top_k(*_sides(t), metric="cosine").withColumn("distance", F.round("distance", 6))


@query(
    "retrieved_wide",
    f"""WITH {_sql_top(_L2)}
        SELECT query_id, {', '.join(f'max(vec_id) FILTER (WHERE rank = {i}) AS doc_{i}' for i in range(1, 6))}
        FROM found GROUP BY 1""",
)
def retrieved_wide(t):
    return R.retrieved_wide(R.top_k(*_sides(t)), "vec_id", 5)


@query("indexed_top_k", f"WITH {_sql_top(_L2, 'q.vec_id % 50 = 0')} SELECT query_id, rank, vec_id, round(d, 6) AS distance FROM found")
def indexed_top_k(t):
    """As ``top_k`` through the inverted index, all cells probed: the exact way of the index."""
    asked, vectors = _indexed_sides(t)
    return V.search(V.build_index(vectors, cells=32), asked, probe=32).withColumn("distance", F.round("distance", 6))


@query("indexed_search")
def indexed_search(t):
    """Through the inverted index, part of the cells probed; each row carries the recall of the whole search against ``top_k``."""
    asked, vectors = _indexed_sides(t)
    found = written(V.search(V.build_index(vectors, cells=32), asked, probe=20), "index-found")
    return found.select("*", V.recall(found, R.top_k(asked, vectors)).scalar().alias("recall"))
