"""Near-duplicates by SimHash: fingerprints, links within a few bits, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, load, map_texts, pieces, written
from .registry import query

#: h of shingles are kept this many at a time while their bits are counted
STRIP = 50_000


def fingerprint(text: bytes, width: int, seed: int = 42) -> int:
    """64 bits; each is set where over half of the shingles' hashes have it. No words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts, ends = ends - np.diff(ends, prepend=0), ends - 1
    n = max(1, len(words) - width + 1)
    starts, ends = starts[:n].tolist(), ends[-n:].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, STRIP):
        hashes = np.array([digest(line[a:b], seed) for a, b in zip(starts[at : at + STRIP], ends[at : at + STRIP])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """(key, fp): fp is the signed form of the 64 bits. Texts are hashed where they are read and never shuffled."""
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1):
            texts = [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in batch.column(1)]
            found = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["key", "fp"])

    return map_texts(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")), run, schema)


class BKForest:
    """BK-trees over 64-bit numbers, distinct within a group, one tree for each group and all of them side by side.

    A node is a number, its children are keyed by their Hamming distance to it: one child for each distance.
    ``groups`` (sorted; one group if left out) says whose tree a number is in. A group's first number is its root, and
    a child always comes later in ``items`` than its parent. All trees grow by one level at a time.
    """

    #: a search holds this many (asked, node) places at a time and goes deep first
    PORTION = 1 << 15

    def __init__(self, items: np.ndarray, groups: np.ndarray | None = None):
        self.items, self.groups = items, np.zeros(len(items), np.int64) if groups is None else groups
        root = np.searchsorted(self.groups, self.groups)
        rest = np.flatnonzero(root != np.arange(len(items)))
        above, edges, children = root[rest], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(rest):
            edge = above * 65 + np.bitwise_count(items[rest] ^ items[above])
            order = np.argsort(edge, kind="stable")
            rest, edge = rest[order], edge[order]
            first = np.diff(edge, prepend=-1) != 0
            edges.append(edge[first])
            children.append(rest[first])
            above, rest = rest[first][np.cumsum(first) - 1][~first], rest[~first]
        edges, children = np.concatenate(edges), np.concatenate(children)
        order = np.argsort(edges)
        self.edges, self.children = edges[order], children[order]

    def search(
        self, wanted: np.ndarray, radius: int, groups: np.ndarray | None = None, before: np.ndarray | None = None
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (place in ``wanted``, place in ``items``) at most ``radius`` bits apart, in portions.

        Each number goes down the tree of its group and follows, from a node, only the edges within ``radius`` of its distance
        to that node. With ``before``, only items before that place are asked for; as children follow their parents, what
        lies under a later item is left out as well.
        """
        groups = np.zeros(len(wanted), np.int64) if groups is None else groups
        before = np.full(len(wanted), len(self.items)) if before is None else before
        node = np.searchsorted(self.groups, groups)
        asked = np.flatnonzero(node < before)
        asked = asked[self.groups[node[asked]] == groups[asked]]
        waiting = [(asked, node[asked])]
        while waiting:
            asked, node = waiting.pop()
            if len(asked) > self.PORTION:
                waiting += [(asked[at : at + self.PORTION], node[at : at + self.PORTION]) for at in range(0, len(asked), self.PORTION)]
                continue
            far = np.bitwise_count(wanted[asked] ^ self.items[node]).astype(np.int64)
            near = far <= radius
            yield asked[near], node[near]
            low = np.searchsorted(self.edges, node * 65 + np.maximum(far - radius, 0))
            many = np.searchsorted(self.edges, node * 65 + np.minimum(far + radius, 64), "right") - low
            asked = np.repeat(asked, many)
            node = self.children[np.repeat(low - (np.cumsum(many) - many), many) + np.arange(len(asked))]
            follow = node < before[asked]
            if follow.any():
                waiting.append((asked[follow], node[follow]))


def roots(n: int, portions: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest member of each of 0..n-1's component, given links in portions that are never kept."""
    parent = np.arange(n)
    for left, right in portions:
        while True:
            a, b = parent[left], parent[right]
            apart = a != b
            if not apart.any():
                break
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
            while (parent[parent] != parent).any():
                parent = parent[parent]
    return parent


def signatures(fps: DataFrame, bits: int, bands: int) -> DataFrame:
    """Each fingerprint once for every choice of bands - bits bands, with those bands' bits and the choice as its bucket.

    Fingerprints at most ``bits`` bits apart differ in at most that many bands, so they agree on all the
    others and share at least one bucket.
    """
    edges = [64 * i // bands for i in range(bands + 1)]
    buckets = []
    for number, chosen in enumerate(combinations(range(bands), bands - bits)):
        mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        buckets.append(F.struct(F.lit(number).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed)).alias("value")))
    return fps.select("fp", F.explode(F.array(*buckets)).alias("bucket")).select("fp", "bucket.choice", "bucket.value")


def group_starts(keys: list[np.ndarray]) -> np.ndarray:
    """Where a new group begins in sorted keys."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def group_pairs(items, mine, low, high, starts, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Near pairs inside groups, as row numbers: one shard of each group is its BK-tree, the other goes down it."""
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(items))))
    tree, asked = np.flatnonzero(mine == low), np.flatnonzero(mine == high)
    forest = BKForest(items[tree], group[tree])
    # a shard that meets itself is asked for what comes before each of its rows
    before = np.where(low[asked] == high[asked], np.searchsorted(tree, asked), len(tree))
    for a, b in forest.search(items[asked], bits, group[asked], before):
        yield asked[a], tree[b]


def bands_for(n: int, bits: int, bucket: int = 64) -> int:
    """The fewest bands, two more than ``bits`` at least, whose buckets hold about ``bucket`` of ``n`` well spread fingerprints at most."""
    bands = bits + 2
    while bands < 64 and n >> (bands - bits) * (64 // bands) > bucket:
        bands += 1
    return bands


def edges_of(low, high, mine, fps, starts, bits: int) -> pa.RecordBatch:
    """An edge from each linked fingerprint to the smallest of its component in its group."""
    root = roots(len(fps), group_pairs(fps.view(np.uint64), mine, low, high, starts, bits) if len(fps) else [])
    linked = np.flatnonzero(root != np.arange(len(fps)))
    return pa.RecordBatch.from_arrays([pa.array(fps[linked]), pa.array(fps[root[linked]])], names=["a", "b"])


def links(fps: DataFrame, bits: int = 4, bands: int | None = None, tree_size: int = 20_000) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are those of all pairs within ``bits`` bits.

    Buckets (see :func:`signatures`) with more than ``tree_size`` fingerprints are dealt into shards of about that
    many; every two shards of a bucket meet in one group, so no group exceeds about twice that. A group, of two
    fingerprints or of many, builds the BK-tree of one shard, sends the other shard (or the same) down it, and returns one edge from
    each linked fingerprint to the smallest of its component in the group, never all pairs. ``bands`` follows from the
    number of fingerprints where it is left out (see :func:`bands_for`).
    """
    bands = bands_for(fps.count(), bits) if bands is None else bands
    spread = signatures(fps, bits, bands)
    sizes = spread.groupBy("choice", "value").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    sizes = written(sizes.withColumn("shards", F.ceil(F.col("n") / tree_size).cast("int")), "simhash-buckets")
    rows = spread.join(sizes, ["choice", "value"])
    mine = F.pmod(F.xxhash64("fp"), F.col("shards")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("shards") - 1),
        lambda other: F.struct(F.least(other, F.col("mine")).alias("low"), F.greatest(other, F.col("mine")).alias("high")),
    )
    rows = rows.withColumn("mine", mine).withColumn("pair", F.explode(meets)).select(
        "choice", "value", "pair.low", "pair.high", "mine", "fp"
    )

    names = ["choice", "value", "low", "high", "mine", "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64) for _ in names]
        for batch in batches:
            rest = [np.concatenate([r, c.to_numpy()]) for r, c in zip(rest, batch.columns)]
            starts = group_starts(rest[:4])
            last = int(starts[-1])
            yield edges_of(*(r[:last] for r in rest[2:]), starts[:-1], bits)
            rest = [r[last:] for r in rest]
        if len(rest[0]):
            yield edges_of(*rest[2:], group_starts(rest[:4]), bits)

    keys = names[:4]
    sorted_rows = rows.select(*names).repartition(*keys).sortWithinPartitions(*keys, "fp")
    found = sorted_rows.mapInArrow(run, "a long, b long")
    return found.distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) can reach.

    Alternating star contractions: every node's larger neighbours, then its smaller ones, are tied to the smallest
    neighbour it knows. Each round is two aggregations and joins and a table in the shared
    folder; the rounds grow with the logarithm of the nodes. It ends when a round changes no edge.
    """

    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"))  # written: a centre with many neighbours then joins in parts

    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "links")
    before = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(smallest(both).withColumn("m", F.least("m", "u")), "large-low")
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        large = written(large, "large-star")
        low = written(smallest(large), "small-low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        edges = written(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, bits: int = 4, bands: int | None = None, tree_size: int = 20_000
) -> DataFrame:
    """For each row: key, ``fp`` and ``component``, the smallest key reachable over fingerprints within ``bits`` bits.

    Words are lower-cased (A-Z) runs between ASCII blanks, shingles ``width`` words; a shorter text is one shingle, a text
    without words (null, empty, blank) has fingerprint 0 and is linked like any other. Copies
    collapse to one fingerprint before any search. BK-trees of all fingerprints on every worker would be
    a broadcast that grows with the corpus, and a radius of ``bits`` visits most of such a tree. So trees are built per
    bucket and shard, and each is sent only to the fingerprints that can be near it. Every link comes from a search in such
    a tree. More ``bands`` make buckets smaller for larger corpora; the result does not depend on ``bands`` and ``tree_size``.
    Rows repeated with their key share a result. An empty table gives an empty table.
    """
    prints = written(fingerprints(docs, key, text, width), "fingerprints")
    owners = written(prints.groupBy("fp").agg(F.min("key").alias("first")), "simhash-owners")
    roots_of = components(links(owners.select("fp"), bits, bands, tree_size))
    member = owners.join(roots_of, F.col("fp") == F.col("node"), "left")
    member = member.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    best = member.groupBy("root").agg(F.min("first").alias("component"))
    placed = written(member.join(best, "root").select("fp", "component"), "simhash-members")
    return prints.join(placed, "fp").select(F.col("key").alias(key), "fp", "component")


def drop_near(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest key, null last; of equal keys, that whose text hashes lowest.

    Rows are told apart by key and text, of which alone the decision depends, so no text is written again to number them.
    Of rows that repeat both, one stays. The rows that go are as many as the copies of the corpus, so they are never broadcast: texts
    move once, at every size, to the task that knows which of them go.
    """
    name, print_of = F.col(f"`{key}`"), F.xxhash64(F.col(f"`{text}`"))
    who = F.struct(name.isNull().alias("none"), name.alias("key"), print_of.alias("print"))
    found = near_duplicates(docs.select(who.alias("who"), F.col(f"`{text}`").alias("text")), "who", "text", **options)
    met = found.groupBy("who").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("who") != F.col("component")).alias("gone"))
    near_key, near_print, gone = fresh(docs, "near_key", "near_print", "near_gone")
    met = met.filter("gone OR n > 1").select(F.col("who.key").alias(near_key), F.col("who.print").alias(near_print), F.col("gone").alias(gone))
    met = written(met, "simhash-decided")
    same = (print_of == F.col(near_print)) & name.eqNullSafe(F.col(near_key))
    once = docs.join(met.hint("merge"), same, "left_anti")
    again = docs.join(met.filter(~F.col(gone)), same, "left_semi").withColumn(near_print, print_of)
    return once.union(again.dropDuplicates([key, near_print]).drop(near_print))


@query("op8_simhash")
def op8_simhash(spark, folder):
    found = near_duplicates(load(spark, folder, "documents").select("doc_id", "text"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), F.col("component").alias("component_id"))
