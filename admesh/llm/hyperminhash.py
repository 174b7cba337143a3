"""Near-duplicate detection with HyperMinHash sketches.

A document's set holds its distinct five-word shingles (lower-cased words). The
hash of a shingle picks one of the sketch's buckets, and each bucket keeps the
smallest rest of the hash in 16 bits: the count of leading zeros and ten bits of
mantissa. Empty buckets borrow from others in a fixed pseudo-random order.

Four registers make a 64-bit band key. Documents that share a band are
candidates; the share of equal registers, corrected for accidental collisions,
estimates their similarity and drops the hopeless ones; the rest is confirmed
on full sets. A link of the threshold's similarity is missed by all bands with
probability (1 - 0.75**4)**40, about 3e-7, and the estimate drops a link only if
it is six standard deviations off.

Not all pairs of a group are needed to find its component. Equal sets collapse
to one representative first. Then each member of a band is compared with the
band's smallest id, the likeliest of these pairs per document first, and with
``TURNS`` further members as long as the band holds several components.

What is left are bands whose members do not all belong together: often a large
group of texts that are alike, but not enough for a link. Listing their pairs
would cost the group's square, so they meet through rare shingles. In an order
of all shingles by frequency, two linked sets agree in one of their first few (as
many as one may miss, and one more: Bayardo, Ma and Srikant, "Scaling up all
pairs similarity search"); the place of the first that agrees bounds what can
still agree after it (Xiao et al., "Efficient similarity joins for near
duplicate detection"). Texts that are alike through common passages have
their rarest shingles to themselves and never meet.
"""

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from admesh.llm.fields import only, without
from admesh.llm.rolling import RangeHashes, chunks, joined, mix, runs_of
from admesh.llm.tables import table
from admesh.operators.components import components, roots
from admesh.storage import RunFolder

WORDS = 5
PERCENT = 75  # least similarity of a link
REGISTERS = 160
BAND = 4  # registers of 16 bits in a key of 64
MANTISSA = 10
TURNS = 2  # further members that a band is compared with before its rare shingles
STEP = 1.05  # between size classes
CHUNK = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_EMPTY = np.uint16(0xFFFF)

SKETCH = "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, registers binary"


def shingles(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every text."""
    buffer, at = joined(texts)
    buffer = _LOWER[buffer]
    starts, ends = runs_of(~_SPACE[buffer])
    word = RangeHashes(buffer).of(starts, ends)
    first = np.searchsorted(starts, at)
    rolled = np.zeros(max(len(word) - words + 1, 0), np.uint64)
    for i in range(words):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + word[i:i + len(rolled)]
    rolled = mix(rolled)
    out = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        if hi - lo >= words:
            own = np.sort(rolled[lo:hi - words + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif hi > lo:
            whole = hi - lo
            for w in word[lo:hi].tolist():
                whole = (whole * 0xD6E8FEB86659FD93 + w) % (1 << 64)
            out.append(mix(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


@lru_cache(maxsize=4)
def _borrowing(count: int) -> np.ndarray:
    """For each bucket, the others in the order in which it borrows from them."""
    return np.stack([np.argsort(mix(np.arange(count, dtype=np.uint64) + np.uint64(1 + i * 1_000_003)), kind="stable")
                     for i in range(count)])


def registers(sets: list[np.ndarray], count: int = REGISTERS) -> np.ndarray:
    """One row of 16-bit registers per set; all ``_EMPTY`` for an empty set.

    A hash times the bucket count has the bucket as its whole part and the rest
    as its fraction, so in sorted hashes the first of a bucket is its smallest.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.full((len(sets), count), _EMPTY, np.uint16)
    if not sizes.sum():
        return out
    h = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), sizes)
    wide, half = np.uint64(32), np.uint64(0xFFFFFFFF)
    times = np.uint64(count)
    bucket = (((h >> wide) * times + (((h & half) * times) >> wide)) >> wide).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (row[1:] != row[:-1])]))
    rest = (h[first] * times).astype(np.float64)
    fraction, exponent = np.frexp(np.maximum(rest, 1.0))
    zeros = np.clip(64 - exponent, 0, 62)
    mantissa = np.minimum(((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.int64), (1 << MANTISSA) - 1)
    out[row[first], bucket[first]] = (zeros << MANTISSA | mantissa).astype(np.uint16)
    return _filled(out, sizes > 0)


def _filled(out: np.ndarray, some: np.ndarray) -> np.ndarray:
    count = out.shape[1]
    order = _borrowing(count)
    own = out.copy()
    row, bucket = np.nonzero((own == _EMPTY) & some[:, None])
    for step in range(count):
        if not len(row):
            break
        lent = own[row, order[bucket, step]]
        got = lent != _EMPTY
        out[row[got], bucket[got]] = lent[got]
        row, bucket = row[~got], bucket[~got]
    return out


def similarity(a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of register rows, corrected for accidental collisions.

    Two different minima share a register with a probability of about 0.1699 *
    2**-mantissa * 4x / (1 + x)**2 for x shingles per bucket (Yu and Weber,
    "HyperMinHash: MinHash in LogLog space").
    """
    count = a.shape[1]
    equal = (a == b).mean(1)
    x = np.maximum(sizes, 1) / count
    chance = 0.169919487159739 * 2.0**-MANTISSA * 4 * x / (1 + x) ** 2
    return np.clip((equal - chance) / (1 - chance), 0, 1)


def sketch(docs: DataFrame, count: int = REGISTERS) -> DataFrame:
    """``doc_id``, set size, 128-bit identity of the set, and its registers, of every row of ``doc_id, text``."""
    def run(batches: Iterator[pa.RecordBatch]):
        for part in chunks(batches, CHUNK):
            sets = shingles([t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()])
            rows = registers(sets, count)
            keys = [np.array([mix(s + np.uint64(c)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                    for c in (1, 0x51ED270B)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), *map(pa.array, keys),
                 pa.array([r.tobytes() for r in rows], pa.binary())],
                ["doc_id", "n_shingles", "k1", "k2", "registers"])
    return docs.select("doc_id", "text").mapInArrow(run, SKETCH)


def _bands(reps: DataFrame, count: int) -> DataFrame:
    """``doc_id, key`` with a 64-bit key of the band's number and packed registers, for each band.

    Two bands of different content meet under a key about never; if they do, they
    are two candidates more.
    """
    width = 2 * BAND

    def key(i: Column) -> Column:
        return F.xxhash64(i, F.substring(F.col("registers"), i * width + 1, F.lit(width)))
    keys = F.transform(F.sequence(F.lit(0), F.lit(count // BAND - 1)), key)
    return reps.select("doc_id", F.explode(keys).alias("key"))


def _likely(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sketches allow the similarity, with their ``estimate``."""
    def run(batches):
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
                        if batch.num_rows else np.zeros((0, 1), np.uint16) for c in ("ra", "rb"))
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            near = similarity(one, two, np.maximum(na, nb))
            bar = percent / 100
            slack = 6 * np.sqrt(bar * (1 - bar) / np.minimum(one.shape[1], np.minimum(na, nb)))
            likely = pa.array((near >= bar - slack) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(likely), batch.column("b").filter(likely), pa.array(near).filter(likely)],
                ["a", "b", "estimate"])

    def side(name):
        return reps.select(F.col("doc_id").alias(name), F.col("n_shingles").alias("n" + name),
                           F.col("registers").alias("r" + name))
    return (
        pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
        .mapInArrow(run, "a bigint, b bigint, estimate double")
    )


def _confirmed(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b``, a written table, whose full sets reach the similarity."""
    def run(batches):
        for part in chunks(batches, CHUNK, "ta"):
            one, two = (shingles(part.column(c).cast(pa.binary()).to_pylist()) for c in ("ta", "tb"))
            both = np.array([len(np.intersect1d(a, b, assume_unique=True)) for a, b in zip(one, two)], np.int64)
            all_ = np.array([len(a) + len(b) for a, b in zip(one, two)], np.int64) - both
            near = pa.array(100 * both >= percent * all_)
            yield pa.RecordBatch.from_arrays([part.column("a").filter(near), part.column("b").filter(near)], ["a", "b"])

    asked = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("doc_id"))
    named = only(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), asked)
    texts = named.join(asked, "doc_id")

    def text(name):
        return F.max(F.when(F.col("doc_id") == F.col(name), F.col("text"))).alias("t" + name)
    return texts.groupBy("a", "b").agg(text("a"), text("b")).mapInArrow(run, "a bigint, b bigint")


def _sets(members: DataFrame, docs: DataFrame, repeated: bool) -> DataFrame:
    """``doc_id, h, size``: a row for every shingle of the members, with their number; ``repeated`` if ids may repeat."""
    def run(batches):
        for part in chunks(batches, CHUNK):
            sets = shingles(part.column("text").cast(pa.binary()).to_pylist())
            sizes = np.array([len(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(part.column("doc_id").to_numpy(), sizes)),
                 pa.array(np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)),
                 pa.array(np.repeat(sizes, sizes).astype(np.int32))], ["doc_id", "h", "size"])
    texts = only(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), members).join(members.select("doc_id"), "doc_id")
    if repeated:
        texts = texts.groupBy("doc_id").agg(F.max("text").alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, h bigint, size int")


def _rare_pairs(members: DataFrame, docs: DataFrame, run: RunFolder, percent: int, repeated: bool = True) -> DataFrame:
    """Pairs ``a, b`` of members ``doc_id, component`` in different components that can reach the similarity, by their rarest shingles.

    Sets of sizes x and y need ``percent * (x + y) / (100 + percent)`` common
    shingles. In the order of frequency, then hash, a first common shingle at
    place i leaves at most x - i of them. So the smaller set (of equal ones, that
    of the smaller id) is entered with its first x / 7 shingles, at 75 percent,
    and the larger looks up its first y / 4, each only among the sizes for which
    it could still be the first. Shingles of one document alone come first in
    the order and meet nothing, so only their number is needed. Whole components
    are matched before documents, so that a component's own pairs are not listed.
    """
    sets = _sets(members, docs, repeated)
    frequent = run.write(sets.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "frequent")
    own = Window.partitionBy("doc_id")
    size, place = F.col("size").cast("bigint"), F.col("place")
    alone = size - F.count(F.lit(1)).over(own)
    left = size - place  # this one and those after it
    rare = run.write(
        sets.join(frequent, "h").withColumn("place", alone + F.row_number().over(own.orderBy("n", "h")) - 1)
        .filter(100 * left >= percent * size).join(members, "doc_id")
        .select("h", "doc_id", "component", size.alias("size"), "place"), "rare")

    def size_class(n):
        return F.floor(F.log(n.cast("double")) / math.log(STEP))
    entered = rare.filter((100 + percent) * left >= 2 * percent * size).select(
        "h", size_class(size).alias("class"), F.col("doc_id").alias("a"), F.col("component").alias("ca"),
        size.alias("na"), place.alias("i"))
    least = F.ceil(percent * size / 100)
    most = F.least(size, F.floor((100 + percent) * left / percent) - size)
    asked = rare.filter(most >= least).select(
        "h", F.explode(F.sequence(size_class(least), size_class(most))).alias("class"), F.col("doc_id").alias("b"),
        F.col("component").alias("cb"), size.alias("nb"), place.alias("j"))
    key = ["h", "class"]
    mixed = entered.select(*key, "ca").distinct().join(asked.select(*key, "cb").distinct(), key).filter("ca != cb")
    possible = (
        ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
        & (100 * F.col("na") >= percent * F.col("nb"))
        & ((100 + percent) * F.least(F.col("na") - F.col("i"), F.col("nb") - F.col("j")) >= percent * (F.col("na") + F.col("nb"))))
    met = mixed.join(entered, [*key, "ca"]).join(asked, [*key, "cb"]).filter(possible)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, run: RunFolder, percent: int = PERCENT, count: int = REGISTERS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``doc_id, text``.

    Documents whose shingle sets have at least ``percent`` similarity are
    linked; ``component_id`` is the smallest id reachable over links, itself
    included, and ``kept`` marks that document. A text without words, or null,
    is linked with nothing. Ids name documents: rows that repeat an id count as
    one document, compared by its greatest text. A row with a null id is its own
    component and kept. Other columns are ignored.
    """
    known = run.write(sketch(docs.filter(F.col("doc_id").isNotNull()), count), "sketches")
    groups = run.write(
        known.filter("n_shingles > 0").groupBy("k1", "k2")
        .agg(F.min(F.struct("doc_id", "n_shingles", "registers")).alias("r")).select("k1", "k2", "r.*"), "groups")
    reps = groups.select("doc_id", "n_shingles", "registers")
    bands = run.write(_bands(reps, count), "bands")
    shared = run.write(
        bands.groupBy("key").agg(F.min("doc_id").alias("center"), F.max("doc_id").alias("last"))
        .filter("center < last").drop("last"), "shared")
    members = run.write(bands.join(shared, "key").join(reps.select("doc_id", "n_shingles"), "doc_id"), "members")
    stars = members.filter("doc_id != center").select(F.col("center").alias("a"), F.col("doc_id").alias("b")).distinct()
    likely = run.write(_likely(stars, reps, percent), "likely")
    best = run.write(likely.groupBy("b").agg(F.max_by("a", "estimate").alias("a")).select("a", "b"), "best")
    first = run.write(_confirmed(best, docs, percent), "confirmed")
    labels = roots(first.select(F.col("b").alias("id"), F.col("a").alias("parent")), run)

    def joined_up(labels, pairs):
        """Labels after the confirmed ones of ``pairs`` have linked their components."""
        pairs = run.write(pairs, "pairs")
        more = run.write(_confirmed(pairs, docs, percent), "confirmed") if pairs.head(1) else None
        if more is None or not more.head(1):
            return labels
        for name in ("a", "b"):
            own = labels.select(F.col("id").alias(name), F.col("component").alias("c" + name))
            more = more.join(own, name, "left").withColumn("c" + name, F.coalesce("c" + name, name))
        merged = components(more.select(F.col("ca").alias("a"), F.col("cb").alias("b")), run)
        raised = merged.withColumnRenamed("id", "old").withColumnRenamed("component", "new")
        every = labels.union(merged.join(labels, "id", "left_anti"))
        return run.write(
            every.join(raised, F.col("component") == F.col("old"), "left")
            .select("id", F.coalesce("new", "component").alias("component")), "labels")

    def apart(pairs):
        """The pairs whose documents lie in different components."""
        for name in ("a", "b"):
            own = labels.select(F.col("id").alias(name), F.col("component").alias("c" + name))
            pairs = pairs.join(own, name, "left")
        return pairs.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")

    def unsettled():
        """Members of bands whose members lie in different components."""
        named = members.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
            "key", "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component"))
        mixed = run.write(
            named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
            .filter("low != high").select("key"), "mixed")
        return run.write(named.join(mixed, "key"), "own")

    def alike(one, two):
        return 100 * F.least(one, two) >= percent * F.greatest(one, two)

    # Members of a band in different components: with the band's center first, then with a few
    # others of the band, which joins up most of a group, and at last through rare shingles.
    labels = joined_up(labels, apart(likely.join(best, ["a", "b"], "left_anti")))
    own = unsettled()
    for turn in range(TURNS):
        centers = own.groupBy("key").agg(F.min(F.struct(
            F.xxhash64("doc_id", F.lit(turn)).alias("h"), F.col("doc_id").alias("center"),
            F.col("component").alias("cc"), F.col("n_shingles").alias("nc"))).alias("c")).select("key", "c.*")
        pairs = own.join(centers, "key").filter((F.col("component") != F.col("cc")) & alike("n_shingles", "nc"))
        pairs = pairs.select(F.least("doc_id", "center").alias("a"), F.greatest("doc_id", "center").alias("b")).distinct()
        labels = joined_up(labels, _likely(pairs, reps, percent).select("a", "b"))
        own = unsettled()

    still = own.select("doc_id", "component").distinct()
    repeated = bool(known.groupBy("doc_id").count().filter("count > 1").head(1))
    across = _rare_pairs(run.write(still, "open"), docs, run, percent, repeated).join(stars, ["a", "b"], "left_anti")
    labels = joined_up(labels, _likely(across, reps, percent).select("a", "b"))
    classes = groups.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "k1", "k2", F.coalesce("component", "doc_id").alias("class"), F.lit(True).alias("some"))
    found = (
        known.withColumn("some", F.col("n_shingles") > 0).join(classes, ["k1", "k2", "some"], "left")
        .select("doc_id", "n_shingles", F.coalesce("class", "doc_id").alias("component_id")))
    unnamed = sketch(docs.filter(F.col("doc_id").isNull()), count).select(
        "doc_id", "n_shingles", F.lit(None).cast("bigint").alias("component_id"))
    return found.union(unnamed).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, run: RunFolder, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without the near duplicates of a document with a smaller id.

    Rows that repeat a kept id all stay, and so do rows with a null id.
    """
    return without(docs, run.write(near_duplicates(docs, run, percent).filter(~F.col("kept")).select("doc_id").distinct(), "gone"))


def op6_hyperminhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's shingle count, component of near duplicates, and whether it is the one kept."""
    return near_duplicates(table(spark, folder, "documents"), RunFolder(spark))
