"""Benchmark decontamination in DataFrame operations only.

Documents and benchmark items are compared as words (lower case, letters and
digits). A document and an item are looked at together if they share one of the
item's rarest shingles: of its three-word shingles, the rarest in the corpus that
carry more than a quarter of its weight. A window of similarity 0.75 misses less
than that, so it holds one of them, while passages of frequent words meet
nothing. Windows of the item's size are then laid where any shared shingle puts
them. A bit field tells which shingles of a document can be an item's, so the
corpus is read once for these and once more for the few documents with windows.
Equal windows collapse to one.

Each window and item has a 64-bit SimHash of its shingles, weighted by their
length. Fingerprints within ``RADIUS`` bits are found by a multi-index: of eight
blocks of 8 bits one must be within ``RADIUS // 8`` bits, so every item is
stored under all its blocks' neighbours of that distance and every window is
looked up under its own blocks. Candidates are then verified exactly by the
weighted similarity of their shingle multisets.

At a similarity of 0.75 the shingles' cosine is about 0.857, so a bit differs
with probability 0.172 and a pair by 11 bits on average. ``RADIUS`` lies four
standard deviations above: of 64 bits more than 23 differ in 1 pair of 10,000. A window
that repeats one shingle many times over has a smaller cosine and can be missed.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from admesh.llm.fields import bit_field, may_hold, only, without
from admesh.llm.tables import table
from admesh.storage import RunFolder

SHINGLE = 3
RADIUS = 23
BLOCKS = 8
BITS = 64 // BLOCKS
SIMILARITY = 0.75
FIELD_BITS = 256  # of the bit field for each distinct item shingle


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits; empty for a null text."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _shingle_hash(words: Column, at: Column) -> Column:
    return F.xxhash64(*(F.get(words, at + i) for i in range(SHINGLE)))


def _starts(words: Column) -> Column:
    """Positions of all shingles; none in a text with fewer words."""
    last = F.size(words) - SHINGLE
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _shingles(words: Column) -> Column:
    """``h, w, s`` of each shingle: hash, weight (code points) and text."""
    def at(i):
        s = F.concat_ws(" ", *(F.get(words, i + k) for k in range(SHINGLE)))  # a slice would copy the whole array
        return F.struct(_shingle_hash(words, i).alias("h"), F.length(s).cast("bigint").alias("w"), s.alias("s"))
    return F.transform(_starts(words), at)


def simhash(shingles: Column) -> Column:
    """64 bits, each set if the shingles with that hash bit have more than half of the weight."""
    def ones(bit):  # of two bits at once, one in each half of a long
        return F.aggregate(shingles, F.lit(0).cast("bigint"), lambda sum_, s: sum_ + s["w"] * F.call_function(
            "shiftrightunsigned", s["h"], bit).bitwiseAND(F.lit(1 << 32 | 1)))

    def vote(sum_, total, bit):
        return F.when(2 * sum_ > total, F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).otherwise(
            F.lit(0).cast("bigint"))

    def signs(total):
        summed = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda bit: F.struct(bit.alias("bit"), ones(bit).alias("ones")))
        return F.aggregate(summed, F.lit(0).cast("bigint"), lambda all_, at: all_.bitwiseOR(
            vote(at["ones"].bitwiseAND(F.lit((1 << 32) - 1)), total, at["bit"])).bitwiseOR(
            vote(F.shiftrightunsigned(at["ones"], 32), total, at["bit"] + 32)))
    return F.transform(F.array(weight(shingles)), signs)[0]  # the weight is summed once


def weight(shingles: Column) -> Column:
    """Code points of all shingles together."""
    return F.aggregate(shingles, F.lit(0).cast("bigint"), lambda sum_, s: sum_ + s["w"])


def _block(fingerprint: Column, block: int) -> Column:
    return F.shiftrightunsigned(fingerprint, BITS * block).bitwiseAND(F.lit((1 << BITS) - 1).cast("bigint"))


def _near_masks() -> list[int]:
    """All values of a block with at most ``RADIUS // BLOCKS`` bits set."""
    return [m for m in range(1 << BITS) if m.bit_count() <= RADIUS // BLOCKS]


def _under_blocks(side: DataFrame, masks: list[int]) -> DataFrame:
    """A row for each block of ``fingerprint`` and mask, with the block's value under that mask."""
    values = [F.struct(F.lit(block).alias("block"), _block(F.col("fingerprint"), block).bitwiseXOR(F.col("mask")).alias("value"))
              for block in range(BLOCKS)]
    listed = F.split(F.lit(",".join(map(str, masks))), ",").cast("array<bigint>")
    return side.withColumn("mask", F.explode(listed)).withColumn("key", F.explode(F.array(*values))).select(
        "*", "key.*").drop("mask", "key")


def _similar(sides: DataFrame, keys: list[str], bench: DataFrame, similarity: float) -> DataFrame:
    """``keys, item, similarity`` of the windows that reach it.

    ``sides`` holds ``keys, item, shingles, weight``, one row for each key and
    item. Similarity is the weight of the common shingles over the weight of
    all, repetitions counted, by one row per distinct shingle of either side.
    """
    key = [*keys, "item"]
    own = sides.select(*key, "weight", F.explode("shingles.s").alias("s")).groupBy(*key, "weight", "s").agg(
        F.count(F.lit(1)).alias("n"))
    item = bench.select("item", F.col("weight").alias("whole"), F.explode("shingles.s").alias("s")).groupBy(
        "item", "whole", "s").agg(F.count(F.lit(1)).alias("m"))
    common = F.sum(F.length("s") * F.least("n", "m"))
    return (
        own.join(item, ["item", "s"]).groupBy(*key, "weight", "whole").agg(common.alias("common"))
        .select(*key, (F.col("common") / (F.col("weight") + F.col("whole") - F.col("common"))).alias("similarity"))
        .filter(F.col("similarity") >= similarity))


def _rarest(seeds: DataFrame, hits: DataFrame, similarity: float) -> DataFrame:
    """``h, item``: of every item, the shingles rarest in ``hits`` with more weight together than a similar window may miss."""
    each = seeds.groupBy("item", "whole", "h").agg(F.sum("w").alias("w"))
    met = hits.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("item").orderBy("n", "h").rowsBetween(Window.unboundedPreceding, -1)
    return (
        each.join(met, "h", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
        .withColumn("before", F.coalesce(F.sum("w").over(order), F.lit(0).cast("bigint")))
        .filter((F.col("n") > 0) & (F.col("before") <= (1 - similarity) * F.col("whole"))).select("h", "item"))


def windows_of(texts: DataFrame, bench: DataFrame, run: RunFolder, similarity: float = SIMILARITY) -> DataFrame:
    """The windows laid in ``doc_id, words``: ``doc_id, item, start, n_words, window, before, after``.

    ``before`` and ``after`` are the up to three words beside the window.
    """
    seeds = run.write(
        bench.select("item", "n_words", F.col("weight").alias("whole"), F.posexplode("shingles").alias("offset", "s")).select(
            F.col("s.h").alias("h"), F.col("s.w").alias("w"), "item", "n_words", "whole", "offset"), "seeds")
    hashes = seeds.select("h").distinct()
    field = bit_field(hashes, FIELD_BITS)
    hits = run.write(
        texts.select("doc_id", "words", F.explode(_starts(F.col("words"))).alias("at"))
        .select("doc_id", "at", F.size("words").alias("size"), _shingle_hash(F.col("words"), F.col("at")).alias("h"))
        .filter(may_hold(field, F.col("h"))), "hits")
    pairs = run.write(hits.join(_rarest(seeds, hits, similarity), "h").select("doc_id", "item").distinct(), "pairs")
    start = F.greatest(F.lit(0), F.least(F.col("at") - F.col("offset"), F.col("size") - F.col("n_words")))
    laid = run.write(
        pairs.join(seeds, "item").join(hits, ["doc_id", "h"]).select("doc_id", "item", start.alias("start"), "n_words").distinct()
        .groupBy("doc_id").agg(F.collect_list(F.struct("item", "start", "n_words")).alias("laid")), "laid")
    first = F.greatest(F.col("start") - SHINGLE, F.lit(0))
    before = F.slice("words", first + 1, F.col("start") - first)
    return run.write(
        only(texts, laid).join(laid, "doc_id").select("doc_id", "words", F.explode("laid").alias("w"))
        .select("doc_id", "words", "w.*", F.slice("words", F.col("w.start") + 1, F.col("w.n_words")).alias("own"))
        .select("doc_id", "item", "start", "n_words", F.concat_ws(" ", "own").alias("window"), before.alias("before"),
                F.slice("words", F.col("start") + F.col("n_words") + 1, SHINGLE).alias("after")), "windows")


def matches(docs: DataFrame, items: DataFrame, run: RunFolder, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, item_id, similarity, start, n_words``: each item's best window in each document.

    ``docs`` has ``doc_id, text``, ``items`` has ``item_id, text``; other columns
    are ignored. One row per pair of which a laid window reaches ``similarity``;
    the best is taken of these and of those up to three words beside them, and
    among equally good windows the first. Null texts are empty. Rows without an id are never
    reported, and items with fewer than three words identify nothing. Rows
    that repeat an id count as one document or item.
    """
    marks = simhash(F.col("shingles")).alias("fingerprint"), weight(F.col("shingles")).alias("weight")
    bench = run.write(
        items.filter(F.col("item_id").isNotNull())
        .select("item_id", words_of(F.col("text")).alias("words"))
        .filter(F.size("words") >= SHINGLE)  # not by the shingles: the filter would take their expression along
        .withColumn("shingles", _shingles(F.col("words")))
        .select(F.monotonically_increasing_id().alias("item"), "item_id", F.size("words").alias("n_words"), "shingles", *marks),
        "items")
    texts = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", words_of(F.col("text")).alias("words"))
    windows = windows_of(texts, bench, run, similarity)
    distinct = run.write(
        windows.select("window", "item").distinct()
        .withColumn("words", F.split("window", " ")).filter(F.size("words") >= SHINGLE)
        .withColumn("shingles", _shingles(F.col("words"))).select("window", "item", "shingles", *marks), "distinct")
    index = _under_blocks(bench.select("item", "fingerprint", F.col("weight").alias("whole")), _near_masks())
    looked_up = _under_blocks(distinct.select("window", "item", F.col("fingerprint"), "weight"), [0])
    w, i = F.col("w.weight"), F.col("i.whole")
    candidates = (
        looked_up.alias("w").join(index.alias("i"), ["item", "block", "value"])
        .filter(F.bit_count(F.col("w.fingerprint").bitwiseXOR(F.col("i.fingerprint"))) <= RADIUS)
        .filter(F.least(w, i) / F.greatest(w, i) >= similarity)  # what is common weighs no more than the lighter side
        .select("window", "item").distinct())
    found = run.write(
        _similar(distinct.join(candidates, ["window", "item"], "left_semi"), ["window"], bench, similarity), "found")
    # An edit within a shingle of an end can make a window beside the laid one the best; a copy has no better one.
    line = F.concat("before", F.split("window", " "), "after")
    shifts = F.when(F.col("similarity") == 1, F.array(F.size("before"))).otherwise(
        F.sequence(F.lit(0), F.size("before") + F.size("after")))
    shifted = run.write(
        windows.join(found, ["window", "item"]).withColumn("line", line).withColumn("shift", F.explode(shifts))
        .select("doc_id", "item", (F.col("start") - F.size("before") + F.col("shift")).alias("start"), "n_words",
                F.concat_ws(" ", F.slice("line", F.col("shift") + 1, F.col("n_words"))).alias("own")).distinct()
        .withColumn("words", F.split("own", " ")).withColumn("shingles", _shingles(F.col("words")))
        .select("doc_id", "item", "start", "n_words", "own", "shingles", weight(F.col("shingles")).alias("weight")), "shifted")
    best = F.max(F.struct("similarity", (-F.col("start")).alias("minus"), "n_words"))
    return (
        _similar(shifted, ["doc_id", "start", "n_words", "own"], bench, similarity).join(bench.select("item", "item_id"), "item")
        .groupBy("doc_id", "item_id").agg(best.alias("b"))
        .select("doc_id", "item_id", F.round("b.similarity", 6).alias("similarity"), (-F.col("b.minus")).alias("start"),
                "b.n_words")
    )


def keep_clean(docs: DataFrame, items: DataFrame, run: RunFolder, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, unchanged; rows with a null id stay."""
    return without(docs, run.write(matches(docs, items, run, similarity).select("doc_id").distinct(), "leaks"))


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and its best window."""
    return matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"), RunFolder(spark))
