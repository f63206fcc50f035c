"""Chunking, embedding and exact nearest-passage search."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_token_array
from ..session import text_batches
from .scoring import batch_function

SEPARATORS = ("\n\n", "\n", " ", "")
BROADCAST_LIMIT = 32 << 20  # bytes of vectors one Python worker may hold whole, of either side
PAIRS = 1 << 28  # comparisons worth a task of their own, about a second


# --- chunks -----------------------------------------------------------------


def chunk_fixed(
    df: DataFrame, text: str, size: int = 500, overlap: int = 30, out: str = "chunk"
) -> DataFrame:
    """Windows of ``size`` characters, each repeating the last ``overlap`` of the one before."""
    step = size - overlap
    starts = F.sequence(F.lit(1), F.greatest(F.length(text) - overlap, F.lit(1)), F.lit(step))
    chunks = F.transform(starts, lambda s: F.substring(F.col(text), s, F.lit(size)))
    rest = [c for c in df.columns if c != text]
    return df.filter(F.length(text) > 0).select(*rest, F.posexplode(chunks).alias("chunk_no", out))


def split_recursive(
    text: str, size: int = 500, overlap: int = 30, separators: Sequence[str] = SEPARATORS
) -> list[str]:
    """Chunks of at most ``size`` characters, cut at the coarsest separator that is fine enough."""
    chunks: list[str] = []
    run: list[str] = []  # pieces of the chunk being filled
    held = 0

    def close() -> None:
        joined = "".join(run).strip()
        if joined:
            chunks.append(joined)

    def add(piece: str) -> None:
        nonlocal held
        if run and held + len(piece) > size:
            close()
            # the tail that fits the overlap, and leaves room, opens the next chunk
            while run and (held > overlap or held + len(piece) > size):
                held -= len(run.pop(0))
        run.append(piece)
        held += len(piece)

    def flush() -> None:
        nonlocal held
        if run:
            close()
            run.clear()
            held = 0

    def walk(part: str, level: int) -> None:
        while separators[level] and separators[level] not in part and level < len(separators) - 1:
            level += 1
        sep = separators[level]
        if sep:
            head, *tail = part.split(sep)
            pieces = [p for p in (head, *(sep + t for t in tail)) if p]
        else:
            pieces = list(part)
        for piece in pieces:
            if len(piece) < size:
                add(piece)
            else:
                flush()
                if level + 1 < len(separators):
                    walk(piece, level + 1)
                else:
                    chunks.append(piece)
        flush()

    walk(text, 0)
    return chunks


def chunk_recursive(
    df: DataFrame, text: str, size: int = 500, overlap: int = 30, out: str = "chunk"
) -> DataFrame:
    """Paragraph, line, word, then character cuts; row-local, only the text visits Python."""

    def make():
        return lambda s: s.map(lambda t: [] if t is None else split_recursive(t, size, overlap))

    text_batches(df.sparkSession)
    rest = [c for c in df.columns if c != text]
    chunks = batch_function(make, "array<string>")(F.col(text))
    # outer: a plain explode would infer a filter on the array and cut every text twice for it
    cut = df.select(*rest, chunks.alias("__c"))
    return cut.select(*rest, F.posexplode_outer("__c").alias("chunk_no", out)).filter(F.col(out).isNotNull())


# --- vectors ----------------------------------------------------------------


def embed(
    df: DataFrame,
    text: str,
    make: Callable[[], Callable[[pd.Series], np.ndarray]],
    out: str = "embedding",
) -> DataFrame:
    """Vectors from a caller's encoder (texts -> 2-d array), loaded once per worker task."""

    def wrapped():
        encode = make()
        return lambda s: pd.Series(list(np.asarray(encode(s), dtype="float32")), index=s.index)

    text_batches(df.sparkSession)
    return df.withColumn(out, batch_function(wrapped, "array<float>")(text))


def embed_hashed(df: DataFrame, text: str, dim: int = 256, out: str = "embedding") -> DataFrame:
    """Offline default: L2-normalised word counts by md5 bucket.

    A word's bucket is the number in the first eight digits of its md5, modulo ``dim``. Words are found in the JVM and cross to
    Python as Arrow lists, where each different word of a batch is hashed once. A text without words, or none at all, has the zero vector.
    """

    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for words in batches:
            n = len(words)
            named = words.flatten().dictionary_encode()
            distinct = named.dictionary.cast(pa.binary()).to_pylist()
            bucket = np.array([int.from_bytes(hashlib.md5(w).digest()[:4], "big") % dim for w in distinct], np.int64)
            row = np.repeat(np.arange(n), pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False))
            counts = np.bincount(row * dim + bucket[named.indices.to_numpy(zero_copy_only=False)], minlength=n * dim).reshape(n, dim)
            norm = np.sqrt((counts * counts).sum(axis=1).astype("float64"))
            unit = (counts / np.where(norm > 0, norm, 1.0)[:, None]).astype("float32")
            yield pa.ListArray.from_arrays(pa.array(np.arange(0, n * dim + 1, dim), pa.int32()), pa.array(unit.ravel()))

    hashed.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    text_batches(df.sparkSession)
    vector = F.arrow_udf(hashed, returnType="array<float>").asNondeterministic()
    return df.withColumn(out, vector(clean_token_array(text)))


def _rows(side, places) -> np.ndarray:
    """Vectors of a side (rows, their lengths or None) in double precision, at unit length where lengths are given."""
    m, norms = side
    out = m[places].astype("float64")
    if norms is not None:
        out /= norms[places][:, None]
    return out


def _slices(n: int, step: int = 8_192) -> list[slice]:
    return [slice(i, min(i + step, n)) for i in range(0, n, step)]


def _few_copies(side, k: int) -> np.ndarray | None:
    """Places of all vectors but those that equal ``k`` earlier ones, which ties by place leave out; None if there are none."""
    m = side[0]
    if len(m) <= k or not m.shape[1]:
        return None
    odd = 2 * np.random.default_rng(0).integers(0, 1 << 62, m.shape[1] * m.itemsize // 4, dtype=np.uint64) + 1
    bits = np.ascontiguousarray(m).view(np.uint32)
    mixed = np.concatenate([(bits[part] * odd).sum(axis=1, dtype=np.uint64) for part in _slices(len(m))])
    order = np.argsort(mixed, kind="stable")
    start = np.searchsorted(mixed[order], mixed[order], "left")
    late = np.arange(len(order)) - start >= k
    again, first = order[late], order[start[late]]
    if not len(again) or not all((bits[again[part]] == bits[first[part]]).all() for part in _slices(len(again))):
        return None
    return np.setdiff1d(np.arange(len(m)), again)


def _set_places(hits: np.ndarray) -> np.ndarray:
    """As ``np.flatnonzero`` of a table of few hits, eight cells at a time."""
    flat = hits.ravel()
    if flat.size % 8:
        return np.flatnonzero(flat)
    cells = (np.flatnonzero(flat.view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return cells[flat[cells]]


def closest(q, v, k: int, step: int = 256, width: int = 2_048) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``q``, row of ``v``, squared distance) of the ``k`` rows of ``v`` nearest to each row of ``q``, the smaller row on ties.

    A side is ``(rows, lengths)``, see :func:`_rows`. A matrix product in single precision screens: around a common middle and at most 1
    in size, so its rounding, for which ``g`` is a bound, is small beside the distances. Direct differences in double precision
    decide, so equal vectors tie exactly. Only ``step`` times ``width`` products are held at a time, however many rows either side has;
    what is already found bounds the next tile.
    """
    n, places = len(q[0]), _few_copies(v, k)
    if places is not None:
        v = (v[0][places], None if v[1] is None else v[1][places])
    total, dim = v[0].shape
    with np.errstate(all="ignore"):
        mid = sum((_rows(v, part).sum(axis=0) for part in _slices(total)), np.zeros(dim)) / max(total, 1)
        size = max([np.abs(_rows(side, part) - mid).max(initial=0.0) for side in (v, q) for part in _slices(len(side[0]))], default=0.0)
        finite = bool(np.isfinite(size * size))
        if not finite:  # no middle and no scale; vectors with a NaN are never found
            mid, size = np.zeros(dim), 1.0
            real = np.concatenate([~np.isnan(_rows(v, part)).any(axis=1) for part in _slices(total)])
            places = np.flatnonzero(real) if places is None else places[real]
            v = (v[0][real], None if v[1] is None else v[1][real])
            total = len(v[0])
        size = size or 1.0
        kind = np.float32 if finite else np.float64
        g = (dim + 16) * float(np.finfo(np.float32).eps)
        loose = 1e-36 + 8 * dim * float(np.finfo(np.float64).eps) * float(np.abs(mid).max(initial=0.0)) / size
        # the product of (-2 q, 1) and (v, |v|^2) is what distances to one q differ by
        screen = np.empty((total, dim + 1), kind)
        for part in _slices(total):
            m = (_rows(v, part) - mid) / size
            screen[part, :dim] = m
            screen[part, dim] = (m * m).sum(axis=1) * (1 - 2 * g)
        held = np.empty((step, width), kind)
        # narrow at first: the first neighbours of all are found among few
        ends = [min(width, 256)]
        while ends[-1] < total:
            ends.append(ends[-1] + min(width, ends[-1]))
        tiles = list(zip([0, *ends], ends))
        out = []
        for i in range(0, n if total else 0, step):
            m = (_rows(q, slice(i, i + step)) - mid) / size
            own = (m * m).sum(axis=1)
            asks = np.ones((len(m), dim + 1), kind)
            asks[:, :dim] = -2.0 * m
            far, hit = np.full((len(m), k), np.nan), np.full((len(m), k), -1)
            bound = np.full(len(m), np.inf)  # squared distance of the k-th found so far, scaled
            for s, end in tiles:
                tile = screen[s:end]
                rough = np.matmul(asks, tile.T, out=held if held.shape == (len(m), len(tile)) else None)
                below = bound
                if len(tile) >= k and np.isinf(bound).any():
                    edge = np.partition(rough, k - 1, axis=1)[:, k - 1] + own * (1 + g) + 4 * g * tile[:, dim].max()
                    below = np.minimum(bound, edge)
                limit = (below * (1 + g) - own * (1 - 2 * g) + loose).astype(kind)[:, None]
                flat = _set_places(rough <= limit if finite else ~(rough > limit))
                if not len(flat):
                    continue
                row, at = np.divmod(flat, len(tile))
                at += s
                dist = np.concatenate([((_rows(v, at[part]) - _rows(q, i + row[part])) ** 2).sum(axis=1) for part in _slices(len(at))])
                if not finite:
                    row, at, dist = (x[~np.isnan(dist)] for x in (row, at, dist))
                new = np.concatenate([[True], row[1:] != row[:-1]])[: len(row)]
                some, row = row[new], np.cumsum(new) - 1
                # what was found before comes first: its places are smaller
                row = np.concatenate([np.repeat(np.arange(len(some)), k), row])
                dist, at = np.concatenate([far[some].ravel(), dist]), np.concatenate([hit[some].ravel(), at])
                counts = np.bincount(row, minlength=len(some))
                order = np.lexsort((dist, row))
                best = order[np.arange(len(order)) - np.repeat(np.cumsum(counts) - counts, counts) < k]
                far[some], hit[some] = dist[best].reshape(-1, k), at[best].reshape(-1, k)
                bound = np.where(hit[:, -1] < 0, np.inf, far[:, -1]) / size / size
            got = hit >= 0
            out.append((np.nonzero(got)[0] + i, hit[got], far[got]))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    row, at, dist = map(np.concatenate, zip(*out))
    return row, at if places is None else places[at], dist


def nearest(qid, q, vid, v, k: int, step: int = 256, width: int = 2_048) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` rows of ``v`` nearest to each row of ``q`` (squared distance, id on ties): ids of both and the distance."""
    order = np.argsort(vid, kind="stable")
    row, at, dist = closest((q, None), (v[order], None), k, step, width)
    return qid[row], vid[order][at], dist


def top_k(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 5,
    metric: str = "l2",
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Exact ``k`` nearest vectors per query: ``(query_id, rank, vec_id, distance)``.

    ``queries(query_id, embedding)`` against ``vectors(vec_id, embedding)`` with unique ids. No
    pair table is ever formed; three shapes, chosen by measured size:

    * the vectors fit ``limit`` (a story's passages): they are broadcast, queries stream past
      them, dealt over all cores where there are many vectors;
    * the queries fit ``limit``: they are broadcast, the vectors are dealt into blocks below ``limit``, each
      returns ``k`` per query;
    * neither fits: both are cut into hash blocks below ``limit``; a block of queries meets each
      block of vectors in a group of its own.
    """
    if metric not in ("l2", "cosine"):
        raise ValueError(f"metric {metric!r}")
    q = queries.select("query_id", "embedding").filter(F.col("embedding").isNotNull())
    v = vectors.select("vec_id", "embedding").filter(F.col("embedding").isNotNull())
    if metric == "cosine":  # a zero vector has no direction
        for_dir = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x) > 0
        q, v = q.filter(for_dir), v.filter(for_dir)

    def measured(df: DataFrame) -> tuple[int, int]:
        width = 4 if dict(df.dtypes)["embedding"] == "array<float>" else 8
        row = df.agg(F.count(F.lit(1)), F.sum(F.size("embedding").cast("bigint") * width + 16)).first()
        return row[0], row[1] or 0

    id_types = f"query_id {dict(q.dtypes)['query_id']}, vec_id {dict(v.dtypes)['vec_id']}"
    schema = f"{id_types}, d2 double"
    (n_v, v_bytes), (n_q, q_bytes) = measured(v), measured(q)
    v_blocks, q_blocks = -(-v_bytes // limit), -(-q_bytes // limit)
    # as many tasks as there is work for, or cores; more where blocks are to stay below the limit
    cores, work = q.sparkSession.sparkContext.defaultParallelism, -(-n_q * n_v // PAIRS)
    tasks = min(2 * cores, work)
    ranked_in_task = v_bytes <= limit
    if ranked_in_task:
        found = _against_vectors(_dealt(q, "query_id", max(q_blocks, tasks)) if tasks > 1 else q, v, k, metric, schema)
    elif q_bytes <= limit:
        found = _against_queries(q, _dealt(v, "vec_id", max(v_blocks, tasks)), k, metric, schema)
    else:
        if q_blocks * v_blocks < min(8 * cores, work):  # groups are dealt by hash: more of them, so that tasks are alike
            groups = min(8 * cores, work)
            # a group returns ``k`` rows per query, so the queries are cut finer
            q_blocks = max(q_blocks, min(groups, round((2 * groups * n_q / n_v) ** 0.5)))
            v_blocks = max(v_blocks, -(-groups // q_blocks))
        found = _by_blocks(q, v, q_blocks, v_blocks, k, metric, schema)
    dist = F.sqrt("d2") if metric == "l2" else F.col("d2") / 2
    if ranked_in_task:
        # every query was compared with all vectors in one call, best first
        return found.select("query_id", "rank", "vec_id", dist.alias("distance"))
    w = Window.partitionBy("query_id").orderBy("d2", F.asc_nulls_last("vec_id"))
    return (
        found.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", dist.alias("distance"))
    )


def _spot(ident: str) -> Column:
    """Where a row is dealt to: by its id, rows without one by their vector."""
    return F.when(F.col(ident).isNull(), F.xxhash64("embedding")).otherwise(F.xxhash64(ident))


def _dealt(df: DataFrame, ident: str, parts: int) -> DataFrame:
    return df.repartition(int(parts), _spot(ident))


def _side(t: pa.Table, metric: str):
    """The vectors of a table as one array, and by 'cosine' their lengths; vectors of several lengths are an error."""
    lists = t.column("embedding").combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    if len(pc.unique(pc.list_value_length(lists))) > 1:
        raise ValueError("all vectors must have the same length")
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    m = (flat if flat.dtype == np.float32 else flat.astype("float64")).reshape(len(lists), -1)
    if metric != "cosine":
        return m, None
    return m, np.concatenate([np.linalg.norm(m[part].astype("float64"), axis=1) for part in _slices(len(m))])


def _by_id(t: pa.Table, ident: str) -> pa.Table:
    """In the order of the ids, rows without one last: ties go by place."""
    t = t.combine_chunks()
    return t.take(pc.sort_indices(t.column(ident)))


def _pairs(query_ids, vec_ids, found) -> pa.Table:
    row, at, dist = found
    return pa.table({"query_id": query_ids.take(pa.array(row)), "vec_id": vec_ids.take(pa.array(at)), "d2": pa.array(dist)})


def _against_vectors(q: DataFrame, v: DataFrame, k: int, metric: str, schema: str) -> DataFrame:
    held = _by_id(v.toArrow(), "vec_id")  # at most the checked limit
    shared = q.sparkSession.sparkContext.broadcast((held.column("vec_id"), _side(held, metric) if held.num_rows else None))

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        some: list[pa.RecordBatch] = []
        for b in batches:
            if b.num_rows:
                some.append(b)
            if sum(x.num_rows for x in some) >= 16_384:
                yield pa.Table.from_batches(some)
                some = []
        if some:
            yield pa.Table.from_batches(some)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, side = shared.value
        for t in tables(batches):
            if side is None:
                continue
            asked = t.column("query_id").combine_chunks()
            found = closest(_side(t, metric), side, k)
            code = np.asarray(pd.factorize(asked.to_pandas(), use_na_sentinel=False)[0])[found[0]]
            rank = (pd.Series(code).groupby(code).cumcount() + 1).to_numpy("int32")
            yield from _pairs(asked, ids, found).append_column("rank", pa.array(rank)).to_batches()

    return q.mapInArrow(run, schema + ", rank int")


def _against_queries(q: DataFrame, v: DataFrame, k: int, metric: str, schema: str) -> DataFrame:
    held = q.toArrow()  # at most the checked limit
    shared = q.sparkSession.sparkContext.broadcast((held.column("query_id"), _side(held, metric) if held.num_rows else None))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, side = shared.value
        block = [b for b in batches if b.num_rows]  # below the limit, as the vectors were dealt
        if block and side is not None:
            t = _by_id(pa.Table.from_batches(block), "vec_id")
            yield from _pairs(ids, t.column("vec_id"), closest(side, _side(t, metric), k)).to_batches(65_536)

    return v.mapInArrow(run, schema)


def _by_blocks(
    q: DataFrame, v: DataFrame, q_blocks: int, v_blocks: int, k: int, metric: str, schema: str
) -> DataFrame:
    # three times as many tasks as groups: few of them get two
    tasks = int(3 * q_blocks * v_blocks)

    def block(df: DataFrame, ident: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return df.withColumn(own, F.pmod(_spot(ident), F.lit(int(n_own))).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(int(n_other) - 1)))
        )

    left = block(q, "query_id", "qb", q_blocks, "vb", v_blocks).repartition(tasks, "qb", "vb").groupBy("qb", "vb")
    right = block(v, "vec_id", "vb", v_blocks, "qb", q_blocks).repartition(tasks, "qb", "vb").groupBy("qb", "vb")

    # tables of Arrow: a block is held as plain numbers, not as one object per row
    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        b = _by_id(b, "vec_id")
        none = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        found = closest(_side(a, metric), _side(b, metric), k) if a.num_rows and b.num_rows else none
        return _pairs(a.column("query_id"), b.column("vec_id"), found)

    return left.cogroup(right).applyInArrow(run, schema)


def retrieved_wide(found: DataFrame, value: str, k: int, key: str = "query_id") -> DataFrame:
    """One column per rank, for export."""
    wide = found.groupBy(key).pivot("rank", list(range(1, k + 1))).agg(F.first(value))
    return wide.toDF(key, *[f"doc_{i}" for i in range(1, k + 1)])
