"""Spelling variants: words one code point apart, grouped under the most frequent form.

A word's prefixes are the nodes on its way through a trie, its suffixes those
on its way through the trie of reversed words. Nodes are numbered, and a word is
entered in a dictionary under pairs of integers: for each position it skips, the
node before and the node after it, and for each gap, the nodes on both sides.
Two words share a pair of skips if they differ by a replaced code point there;
a skip of one and a gap of the other meet if one has a code point more. Numbers
are exact, so the pairs are all neighbours and nothing but neighbours.

Numbering is one sort for each trie: in sorted order a word's new nodes are
those deeper than what it shares with the word before, and only nodes that a
neighbour in the order shares are kept. Tasks number their ranges of words on
their own; what two ranges share is settled from their first and last words.
A pair holds at most one gap, and as many skips as there are code points in the
alphabet, so no group grows with the corpus.
"""

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from admesh.llm.rolling import chunks
from admesh.llm.tables import documents
from admesh.operators.components import roots
from admesh.storage import RunFolder

LETTERS = "A-Za-zÀ-ÿ"
SHORTEST = 7
SLIPS = 31  # a slip of the pen for one in so many words of a document
OFTEN = 2
TIMES = 10  # how much more frequent a form is than its variant
CHUNK = 1_000_000

_SKIP, _FIRST_SKIP, _GAP = range(3)
_ROOT = 0
_ENTRY = "f bigint, r bigint, kind tinyint, id bigint, n bigint"


def occurrences(docs: DataFrame) -> DataFrame:
    """``word`` for every word of at least ``SHORTEST`` code points in ``doc_id, text``, slips included.

    Runs of letters are words, with A-Z lowered. If the checksum of
    ``<doc_id>:<word>`` is a multiple of ``SLIPS``, the word loses one code point,
    at the checksum modulo its length. A null id reads as empty.
    """
    upper, lower = ("".join(chr(c + i) for i in range(26)) for c in (65, 97))
    # A shorter run cannot give a word that counts.
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{SHORTEST},}}"), F.lit(0))
    run = F.translate("run", upper, lower)
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return (
        docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"), F.explode(runs).alias("run"))
        .select("name", run.alias("run"))
        .select("run", F.crc32(F.concat("name", F.lit(":"), "run")).alias("h"))
        .select(F.when(F.col("h") % SLIPS == 0, slipped).otherwise(F.col("run")).alias("word"))
        .filter(F.length("word") >= SHORTEST))


def common(a: str, b: str) -> int:
    """Length of the common prefix."""
    lo, hi = 0, min(len(a), len(b)) + 1
    while hi - lo > 1:
        middle = (lo + hi) // 2
        if a[lo:middle] == b[lo:middle]:
            lo = middle
        else:
            hi = middle
    return lo


def number_nodes(keys: Iterator[str], base: int) -> Iterator[tuple[array, bool]]:
    """For each of the sorted distinct ``keys``, the numbers of its shared nodes by depth, and if it is the last.

    Numbers start at ``base + 1`` and the root is 0. Whether the first and last
    key share nodes beyond this range is not known here, so they keep all.
    """
    before = nodes = None
    shared = count = 0
    for key in keys:
        same = common(before, key) if before is not None else 0
        if before is not None:
            yield nodes[:max(shared, same) + 1], False
        kept = nodes[:same + 1] if before is not None else array("q", [_ROOT])
        nodes = kept + array("q", range(base + count + 1, base + count + 1 + len(key) - same))
        count += len(key) - same
        shared = same if before is not None else len(key)
        before = key
    if before is not None:
        yield nodes, True


def numbered(words: DataFrame, key: Column, name: str) -> DataFrame:
    """``words`` in the order of ``key`` with ``name`` (numbers of the key's shared nodes, as bytes), ``place`` and ``edge``.

    Places ascend with the key. ``edge`` is 1 for the first key of a range, 2
    for the last, 3 for both, else 0.
    """
    columns = words.columns
    ordered = words.withColumn("key", key).repartitionByRange("key").sortWithinPartitions("key")

    def run(batches):
        base = TaskContext.get().partitionId() << 40
        held: list[tuple] = []

        def keys():
            for batch in batches:
                for row in zip(*(batch.column(c).to_pylist() for c in [*columns, "key"])):
                    held.append(row[:-1])
                    yield row[-1]
        out, size, place = [], 0, 0
        for nodes, last in number_nodes(keys(), base):
            row = held.pop(0)
            data = nodes.tobytes()
            out.append((*row, data, base + place, (place == 0) + 2 * last))
            size += len(data) + 50
            place += 1
            if size > 8 * CHUNK:
                yield _rows(out, schema)
                out, size = [], 0
        if out:
            yield _rows(out, schema)
    types = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "int": pa.int32()}
    fields = [*words.dtypes, (name, "binary"), ("place", "bigint"), ("edge", "int")]
    schema = pa.schema([(c, types[t]) for c, t in fields])
    return ordered.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in fields))


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def renames(ranges: DataFrame, key: Column, name: str) -> dict[int, int]:
    """Numbers that a range gave to nodes which an earlier range had numbered, and those numbers.

    Reads the first and last word of every range: a row or two per task.
    """
    ends = ranges.filter("edge > 0").select(key.alias("key"), name, "place", "edge").orderBy("place").collect()
    known: dict[int, int] = {}
    before: tuple[str, list[int]] = ("", [_ROOT])
    for row in ends:
        own = np.frombuffer(row[name], np.int64).tolist()
        if row.edge & 1:
            for depth in range(1, common(before[0], row.key) + 1):
                known[own[depth]] = before[1][depth]
        if row.edge & 2:
            before = row.key, [known.get(x, x) for x in own]
    return known


def _renamed(numbers: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    if not len(old):
        return numbers
    at = np.minimum(np.searchsorted(old, numbers), len(old) - 1)
    return np.where(old[at] == numbers, new[at], numbers)


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and value for all values ``lo <= value <= hi`` of every row."""
    sizes = np.maximum(hi - lo + 1, 0)
    row = np.repeat(np.arange(len(lo)), sizes)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + lo[row]


def entries(words: DataFrame, run: RunFolder) -> tuple[DataFrame, DataFrame]:
    """``id, word, n`` with ids in the order of the words, and their entries in the dictionary of node pairs.

    An entry ``f, r, kind, id, n`` is a skip, the first of several equal skips (of
    a run of the same code point), or a gap. Entries that no other word can meet
    are left out.
    """
    plain, mirrored = F.col("word"), F.reverse("word")
    forward = run.write(numbered(words.select("word", "n"), plain, "ahead"), "forward")
    named = forward.select("word", "n", F.col("place").alias("id"), "ahead")
    both = run.write(numbered(named, mirrored, "back"), "nodes")
    maps = [np.array(sorted(r.items()), np.int64).reshape(-1, 2) for r in (
        renames(forward, plain, "ahead"), renames(both, mirrored, "back"))]
    shared = words.sparkSession.sparkContext.broadcast(maps)  # at most a word's length for each task of the sorts

    def enter(batches):
        (old_f, new_f), (old_r, new_r) = (m.T for m in shared.value)
        for batch in batches:
            for part in chunks(iter([batch]), CHUNK, "ahead"):
                texts = part.column("word").to_pylist()
                n, ids = (part.column(c).to_numpy() for c in ("n", "id"))
                size = np.array([len(t) for t in texts], np.int64)
                letters = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
                at = np.cumsum(size) - size
                sides = []
                for column, old, new in (("ahead", old_f, new_f), ("back", old_r, new_r)):
                    data = part.column(column).to_pylist()
                    depth = np.array([len(d) // 8 - 1 for d in data], np.int64)
                    sides.append((_renamed(np.frombuffer(b"".join(data), np.int64), old, new), depth, np.cumsum(depth + 1) - depth - 1))
                (f, deep, f_at), (r, high, r_at) = sides
                for gap in (0, 1):
                    rest = size - 1 + gap  # code points beside the skip or the gap
                    row, i = _spread(np.maximum(rest - high, 0), np.minimum(rest, deep))
                    if gap:
                        kind = np.full(len(row), _GAP, np.int8)
                    else:
                        here = at[row] + i
                        fresh = (i == 0) | (letters[here] != letters[here - 1])
                        kind = np.where(fresh, _FIRST_SKIP, _SKIP).astype(np.int8)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(f[f_at[row] + i]), pa.array(r[r_at[row] + rest[row] - i]), pa.array(kind),
                         pa.array(ids[row]), pa.array(n[row])], ["f", "r", "kind", "id", "n"])
    return both.select("id", "word", "n"), both.select("word", "n", "id", "ahead", "back").mapInArrow(enter, _ENTRY)


def near_pairs(words: DataFrame, run: RunFolder) -> DataFrame:
    """Every two distinct words of ``word, n`` one code point apart, once, as ``a, b``."""
    names, found = entries(distinct(words), run)
    found = run.write(found, "entries")
    skips = found.filter(F.col("kind") != _GAP).select("f", "r", F.col("id").alias("one"), "kind")
    replaced = skips.drop("kind").join(skips.select("f", "r", F.col("one").alias("two")), ["f", "r"]).filter("one < two")
    gaps = found.filter(F.col("kind") == _GAP).select("f", "r", F.col("id").alias("two"))
    longer = skips.filter(F.col("kind") == _FIRST_SKIP).drop("kind").join(gaps, ["f", "r"])
    pairs = replaced.unionByName(longer).select("one", "two")
    for side, name in (("one", "a"), ("two", "b")):
        pairs = pairs.join(names.select(F.col("id").alias(side), F.col("word").alias(name)), side)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def distinct(words: DataFrame) -> DataFrame:
    """``word, n`` with the counts of repeated words added up; null words are left out."""
    return words.filter(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))


def neighbourhoods(found: DataFrame) -> DataFrame:
    """``id, n_near, best`` of every word with a neighbour; ``best`` is the most frequent, the first of equals.

    Neighbours are counted within each pair of nodes, without listing them: all
    that a word must know of the others are their number and the two best.
    """
    group = Window.partitionBy("f", "r")
    ranked = group.orderBy(F.col("kind") == _GAP, F.desc("n"), "id").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    kind, own = F.col("kind"), F.struct("n", (-F.col("id")).alias("minus"))
    skip = kind != _GAP

    def best(which):
        return F.max(F.when(which, own)).over(ranked)
    seen = found.select(
        "id", "kind", own.alias("own"), F.count(F.when(skip, True)).over(ranked).alias("skips"),
        F.count(F.when(kind == _FIRST_SKIP, True)).over(ranked).alias("fresh"),
        F.first(own).over(ranked).alias("first"), F.nth_value(own, 2).over(ranked).alias("second"),
        best(kind == _GAP).alias("gap"), best(kind == _FIRST_SKIP).alias("best_fresh"))
    meets_gap = (kind == _FIRST_SKIP) & F.col("gap").isNotNull()
    others = F.when(F.col("skips") > 1, F.when(F.col("own") == F.col("first"), F.col("second")).otherwise(F.col("first")))
    return (
        seen.select(
            "id",
            F.when(skip, F.col("skips") - 1 + meets_gap.cast("bigint")).otherwise(F.col("fresh")).alias("near"),
            F.when(skip, F.greatest(others, F.when(meets_gap, F.col("gap")))).otherwise(F.col("best_fresh")).alias("best"))
        .filter("near > 0").groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best")))


def variants(words: DataFrame, run: RunFolder, times: int = TIMES) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every distinct word of ``word, n``.

    Words are near if they differ by exactly one code point. ``form`` is the near
    word with the largest ``n`` (the first in code-point order of equals) if that
    is at least ``times`` the word's own; ``root`` follows the forms to the last.
    Counts of repeated words are added up; null words are left out, the empty
    word is one like others, and other columns are ignored.
    """
    names, found = entries(distinct(words), run)
    near = run.write(
        names.join(neighbourhoods(found), "id", "left")
        .select("id", "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
                F.when(F.col("best.n") >= times * F.col("n"), F.col("best")).alias("best")), "near")
    parents = near.filter(F.col("best").isNotNull()).select(
        "id", (-F.col("best.minus")).alias("form_id"), F.col("best.n").alias("form_n"))
    # A form is more frequent than its variants, so the links have no circle.
    ends = roots(parents.select("id", F.col("form_id").alias("parent")), run).withColumnRenamed("component", "root_id")
    resolved = parents.join(ends, "id")
    for side in ("form", "root"):
        resolved = resolved.join(near.select(F.col("id").alias(f"{side}_id"), F.col("word").alias(side)), f"{side}_id")
    return near.join(resolved.select("id", "form", "root", "form_n"), "id", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """The words of all documents with their spelling variants' number, form and root."""
    run = RunFolder(spark)
    counted = occurrences(documents(spark, folder)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    words = run.write(counted.filter(F.col("n") >= OFTEN), "words")
    return variants(words, run).select("word", "form", "root", "n", "n_near", "form_n")
