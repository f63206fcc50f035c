"""Benchmark decontamination: documents that hold windows of benchmark items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ascii_lower, fresh, load, written
from .registry import query

#: what stands between words: every ASCII character but letters and digits
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) runs of letters, digits and everything beyond ASCII; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAK), "")


def shingles(words: Column, width: int) -> Column:
    """64-bit hashes of ``width`` consecutive words, by the place of the first."""
    places = F.sequence(F.lit(1), F.size(words) - (width - 1))
    hashed = F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + (k - 1)) for k in range(width)]))
    return F.when(F.size(words) >= width, hashed).otherwise(F.array().cast("array<bigint>"))


def item_windows(items: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """Distinct windows: words, n, and the sorted item ids (as text) that hold them."""
    rows = items.select(F.col(f"`{key}`").cast("string").alias("item"), words_of(F.col(f"`{text}`")).alias("words")).filter("size(words) > 0")
    n = F.least(F.size("words"), F.lit(window))
    places = F.sequence(F.lit(0), F.size("words") - n)
    run = F.transform(places, lambda i: F.transform(F.sequence(i, i + n - 1), lambda j: F.get("words", j)))
    cut = rows.select("item", n.alias("n"), F.explode(run).alias("words"))
    return cut.groupBy("n", "words").agg(F.array_sort(F.collect_set("item")).alias("items"))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    width: int = 4,
) -> DataFrame:
    """For each row: key, ``n_words``, ``n_hit``, ``items`` (sorted ids with occurring windows).

    A window is ``window`` consecutive words of an item, or all of a shorter item. As sets of shingles (``width`` words)
    a document can hold a window only if it holds every shingle of it, so one necessary shingle, the window's prefix in
    order of rarity, is enough to find all candidates:

    1. Document shingles meet the benchmark's shingles once; what matches is written, with its place.
    2. Counts of these matches give the rarity of each shingle in the corpus. A window's rarest shingle is its prefix;
       a window with a shingle that never occurs has no candidate at all.
    3. Matches of the prefix, less the prefix' offset, are the places where the window may start. Length and position
       bounds drop those that would begin before or end after the document.
    4. The words of documents with candidates are compared at that place with the window's words, all of them.

    Hashes only propose; step 4 decides on words. Benchmark tables are written first, so that the planner broadcasts them when they are
    small and otherwise sorts and merges, with skewed shingles split. Hits are counted as the union of the verified windows. An
    item text that is null or has no word has no window. A null item id never shows in ``items`` but its
    windows hit. Rows are told apart by key and text, so rows repeated with their key each get
    the same right result; a null key is a key. Empty tables: no documents, no rows; no items, no hits.
    """
    windows = item_windows(items, item_key, item_text, window)
    windows = windows.select(F.xxhash64("words").alias("a"), F.hash("words").alias("b"), "n", "words", "items")
    windows = written(windows, "bench-windows")
    lengths = sorted(r[0] for r in windows.select(F.least("n", F.lit(width)).alias("w")).distinct().collect())
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    rows = rows.withColumn("print", F.xxhash64("text"))
    if not lengths:
        words = F.size(words_of(F.col("text"))).cast("long").alias("n_words")
        return rows.select(F.col("key").alias(key), words, F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"))

    parts = None
    for w in lengths:
        some = windows.filter(F.col("n") == w) if w < width else windows.filter(F.col("n") >= w)
        part = some.select("a", "b", "n", F.lit(w).alias("w"), F.posexplode(shingles(F.col("words"), w)).alias("offset", "shingle"))
        parts = part if parts is None else parts.union(part)
    parts = written(parts, "bench-shingles")
    # one place more than a document has shingles, marked, carries the number of its words through the same join
    mark, first = F.lit(0).cast("long"), lengths[0]
    marked = docs.sparkSession.range(1).select(F.lit(first).alias("w"), mark.alias("shingle"))
    wanted = written(parts.select("w", "shingle").union(marked).distinct(), "bench-wanted")

    worded = rows.select("key", "print", words_of(F.col("text")).alias("words"))
    met = None
    for w in lengths:
        hashes, known = shingles(F.col("words"), w), wanted.filter(F.col("w") == w).select("shingle")
        if w == first:
            hashes = F.concat(hashes, F.array(mark))
        placed = worded.select("key", "print", F.size("words").alias("size"), F.posexplode(hashes).alias("place", "shingle"))
        met_w = placed.join(known, "shingle").withColumn("w", F.lit(w))
        met = met_w if met is None else met.union(met_w)
    met = written(met, "bench-matches")
    last = F.greatest(F.col("size") - F.col("w") + 1, F.lit(0))
    counted = met.filter((F.col("w") == first) & (F.col("place") == last)).select("key", "print", F.col("size").cast("long").alias("n_words"))
    found = met.filter(F.col("place") < last)

    counts = found.groupBy("w", "shingle").agg(F.count(F.lit(1)).alias("count"))
    ranked = parts.join(counts, ["w", "shingle"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    rarest = Window.partitionBy("a", "b", "n").orderBy("count", "shingle", "offset")
    prefix = ranked.withColumn("r", F.row_number().over(rarest)).filter("r = 1 AND count > 0")
    prefix = written(prefix.select("w", "shingle", "offset", "n", "a", "b"), "bench-prefixes")

    starts = found.join(prefix, ["w", "shingle"]).withColumn("start", F.col("place") - F.col("offset"))
    starts = starts.filter("start >= 0 AND start + n <= size").select("key", "print", "start", "n", "a", "b").distinct()
    texts = windows.select("a", "b", "n", "words", "items")
    tries = starts.join(texts, ["a", "b", "n"]).groupBy("key", "print").agg(
        F.collect_list(F.struct("start", "n", F.col("words").alias("text"), "items")).alias("tries")
    )
    tries = written(tries.select(F.col("key").alias("try_key"), F.col("print").alias("try_print"), "tries"), "bench-candidates")

    def held(t: Column) -> Column:
        # word by word, as a slice would copy the document for each candidate; words is named twice: a column
        # used once would be computed anew for each candidate
        inside = t["start"] + t["n"] <= F.size("words")
        places = F.sequence(F.lit(0), t["n"] - 1)
        return inside & F.forall(places, lambda k: F.get("words", t["start"] + k) == F.get(t["text"], k))

    same = (F.col("print") == F.col("try_print")) & F.col("key").eqNullSafe(F.col("try_key"))
    checked = rows.join(tries, same).withColumn("words", words_of(F.col("text"))).select(
        "key",
        "print",
        F.filter("tries", held).alias("real"),
    )
    spans = F.array_sort(F.transform("real", lambda t: F.struct(t["start"].alias("start"), t["n"].alias("n"))))
    state = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit"))

    def cover(state: Column, span: Column) -> Column:
        end = span["start"] + span["n"]
        return F.struct(
            F.greatest(state["end"], end).alias("end"),
            (state["hit"] + F.greatest(end - F.greatest(state["end"], span["start"]), F.lit(0))).alias("hit"),
        )

    ids = F.array_sort(F.array_distinct(F.flatten(F.transform("real", lambda t: t["items"]))))
    # candidates without a hit stay: a filter on ``real`` would be pushed below and compute it, and the words, again
    hits = checked.select(
        F.col("key").alias("hit_key"), F.col("print").alias("hit_print"), F.aggregate(spans, state, cover, lambda s: s["hit"]).alias("hit"), ids.alias("ids")
    )
    hits = written(hits.dropDuplicates(["hit_key", "hit_print"]), "bench-hits")
    mine = (F.col("print") == F.col("hit_print")) & F.col("key").eqNullSafe(F.col("hit_key"))
    return counted.join(hits, mine, "left").select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("ids", F.array().cast("array<string>")).alias("items"),
    )


def is_contaminated() -> Column:
    """Any hit, and at least one word in twenty hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` less the contaminated ones. Rows are told apart by key (null keys too) and text, of which alone the decision depends."""
    print_of = F.coalesce(F.xxhash64(F.col(f"`{text}`")), F.lit(0))
    who = F.struct(F.col(f"`{key}`").alias("key"), print_of.alias("print"))
    found = contamination(docs.select(who.alias("who"), F.col(f"`{text}`").alias("text")), items, "who", "text", **options)
    bad_key, bad_print = fresh(docs, "bad_key", "bad_print")
    bad = found.filter(is_contaminated()).select(F.col("who.key").alias(bad_key), F.col("who.print").alias(bad_print)).distinct()
    bad = written(bad, "contaminated")
    same = (print_of == F.col(bad_print)) & F.col(f"`{key}`").eqNullSafe(F.col(bad_key))
    return docs.join(bad, same, "left_anti")


@query("op9_decontamination")
def op9_decontamination(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "text")
    done = contamination(docs, load(spark, folder, "benchmark"))
    return done.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )
