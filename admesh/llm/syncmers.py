"""Document fingerprints from closed syncmers.

A k-mer (``K`` bytes of the text) is a closed syncmer if the smallest hash among
its inner ``S``-mers is the first or the last one. That depends on the k-mer
alone, so an edit changes only the syncmers it touches, and equal passages have
equal syncmers wherever they stand: anchors without a context.

A fingerprint keeps the ``SIZE`` syncmers with the smallest hashes, each with the
position of its first occurrence. Two fingerprints are compared over the
smallest hashes of both together. A common anchor counts if it has the shift in
position that most common anchors share, give or take ``SLACK``, so scattered
accidental matches add nothing.
"""

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from admesh.llm.rolling import RangeHashes, chunks, joined, mix
from admesh.llm.tables import documents

K = 16
S = 6
SIZE = 64
SLACK = 64
CHUNK = 500_000
BUCKETS = 65_536  # the most ranges of ids, whose bounds reach the driver
BUCKET_ROWS = 5_000

PAIRED = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def closed_syncmers(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, position and hash of every closed syncmer."""
    buffer, at = joined(texts)
    if len(buffer) < K:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64))
    hashes = RangeHashes(buffer)
    here = np.arange(len(buffer) - S + 1)
    inner = hashes.of(here, here + S)
    count = K - S + 1
    low, size = inner, 1
    while size * 2 <= count:
        low, size = np.minimum(low[size:], low[:-size]), size * 2
    if count > size:
        low = np.minimum(low[count - size:], low[:size - count])
    n = len(low)
    start = np.flatnonzero((inner[:n] == low) | (inner[count - 1:count - 1 + n] == low))
    doc = np.searchsorted(at, start, "right") - 1
    within = start + K <= at[doc + 1] - 1
    start, doc = start[within], doc[within]
    return doc, start - at[doc], mix(hashes.of(start, start + K))


def fingerprints(texts: list[bytes]) -> list[str]:
    """The fingerprint of every text: ``hash:position`` in hexadecimal, by hash.

    A text without a syncmer (shorter than ``K`` bytes) is one anchor by itself;
    an empty text has an empty fingerprint.
    """
    doc, place, h = closed_syncmers(texts)
    h = h >> np.uint64(24)
    order = np.lexsort((place, h, doc))
    doc, place, h = doc[order], place[order], h[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    doc, place, h = doc[first], place[first], h[first]
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    out = []
    for i, text in enumerate(texts):
        lo, hi = bounds[i], min(bounds[i + 1], bounds[i] + SIZE)
        if lo < hi:
            out.append(" ".join([f"{a:010x}:{b:x}" for a, b in zip(h[lo:hi].tolist(), place[lo:hi].tolist())]))
        else:
            out.append(f"{int.from_bytes(hashlib.blake2b(text, digest_size=5).digest()):010x}:0" if text else "")
    return out


def likeness(one: str, two: str) -> float:
    """Share of common anchors in line with each other, 0 to 1; equal fingerprints have 1."""
    if one == two:
        return 1.0
    a, b = (dict(x.split(":") for x in f.split(" ")) if f else {} for f in (one, two))
    if not a or not b:
        return 0.0
    # What both would have kept: the smallest hashes of the union, none beyond a full fingerprint's last.
    union = sorted(a.keys() | b.keys())
    limit = min((max(f) for f in (a, b) if len(f) == SIZE), default=union[-1])
    union = [h for h in union if h <= limit][:SIZE]
    shifts = np.sort(np.array([int(a[h], 16) - int(b[h], 16) for h in union if h in a and h in b], np.int64))
    if not len(shifts):
        return 0.0
    aligned = (np.searchsorted(shifts, shifts + SLACK, "right") - np.arange(len(shifts))).max()
    return float(aligned) / len(union)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many code points from the start of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every row; a null text counts as empty. Runs without a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]):
        for part in chunks(batches, CHUNK):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(fingerprints([(t or "").encode() for t in part.column("text").to_pylist()]))],
                ["doc_id", "fingerprint"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, fingerprint string")


def _count_below(value: Column, edges: list[int]) -> Column:
    """How many of the sorted ``edges`` are below the value, by way of every so-manieth edge."""
    if not edges:
        return F.lit(0)
    step = math.isqrt(len(edges) - 1) + 1

    def below(some):
        return F.size(F.filter(some, lambda e: e < value))
    coarse = F.greatest(below(F.lit(edges[::step])) - 1, F.lit(0)) * step
    return coarse + below(F.slice(F.lit(edges), coarse + 1, F.lit(step)))


def with_following(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, text, following``: each text with that of the next id, the last with the first's.

    Ids are dealt into ranges of about equal count by approximate quantiles.
    Each range gets a copy of the next range's first document, so a window per
    range finds every follower. At most ``buckets`` ids reach the driver. Equal
    ids are ordered by text; null ids come first.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    steps = min(buckets, max(docs.sparkSession.sparkContext.defaultParallelism * 4, docs.count() // BUCKET_ROWS))
    shares = [i / steps for i in range(1, steps)]
    bounds = sorted(set(docs.approxQuantile("doc_id", shares, 0.5 / steps))) if shares else []
    placed = docs.withColumn("bucket", F.when(F.col("doc_id").isNull(), -1).otherwise(
        _count_below(F.col("doc_id"), [int(b) for b in bounds])))
    ranges = sorted((r.bucket, r.first) for r in placed.groupBy("bucket").agg(F.min("doc_id").alias("first")).collect())
    if not ranges:
        return docs.withColumn("following", F.lit(""))
    before = [(first, ranges[i - 1][0]) for i, (_, first) in enumerate(ranges)]
    # Bounded by the number of ranges.
    heads = F.broadcast(docs.sparkSession.createDataFrame(before, "first bigint, previous int"))
    copies = (
        docs.join(heads, F.col("doc_id").eqNullSafe(F.col("first")))
        .groupBy("doc_id", "previous").agg(F.min("text").alias("text"))
        .select("doc_id", "text", F.col("previous").alias("bucket"), F.lit(True).alias("copy")))
    line = Window.partitionBy("bucket").orderBy("copy", F.col("doc_id").asc_nulls_first(), "text")
    return (
        placed.withColumn("copy", F.lit(False)).unionByName(copies)
        .withColumn("following", F.lead("text").over(line)).filter(~F.col("copy"))
        .select("doc_id", "text", "following"))


def compare_edits(docs: DataFrame) -> DataFrame:
    """Fingerprint every text and its edited text, and compare it with that and with the next document.

    See ``PAIRED`` for the columns. Rows of equal ids follow each other by text;
    the document after the last is the first. Other columns are ignored, and an
    empty table gives no rows.
    """
    def run(batches):
        last: tuple[str, str] = ("", "")  # a text is usually the follower of the row before
        for part in chunks(batches, CHUNK):
            texts, following = part.column("text").to_pylist(), part.column("following").to_pylist()
            edits = [edited(a, b) for a, b in zip(texts, following)]
            need = dict.fromkeys(t for t in [*texts, *edits, *following] if t != last[0])
            prints = dict(zip(need, fingerprints([t.encode() for t in need])))
            prints[last[0]] = last[1] if last[0] else ""
            prints[""] = ""
            last = (following[-1], prints[following[-1]]) if following else last
            yield pa.RecordBatch.from_pylist([
                {"doc_id": i, "n_chars": len(t), "edited_sha256": hashlib.sha256(e.encode()).hexdigest(),
                 "fingerprint": prints[t], "edited_fingerprint": prints[e],
                 "near_edited": likeness(prints[t], prints[e]), "near_next": likeness(prints[t], prints[f])}
                for i, t, e, f in zip(part.column("doc_id").to_pylist(), texts, edits, following)], schema)
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                        ("near_edited", pa.float64()), ("near_next", pa.float64())])
    return with_following(docs).mapInArrow(run, PAIRED)


def op4_syncmers(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, and the likeness of both and of the next document's."""
    return compare_edits(documents(spark, folder))
