"""Quality classifier trained on the posterior labels of a weak-label model.

Heuristic labellers vote on documents: reject, keep, or abstain. They overlap
and err, and nobody says how often, so expectation-maximisation estimates every
labeller's accuracies together with the documents' posterior labels. Those
posteriors train a hashed linear scorer, which judges every document. Junk and
toxicity have different causes, so each has its own labellers and scorer.

The labellers see the shape of a text (marks, capitals, separators, repetition),
a gazetteer of insults, words and word stems that go with toxic labels, and the
noisy human labels. The fit uses a bounded sample of labelled documents; the
rest runs over all documents without a shuffle.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from admesh.llm.rolling import RangeHashes, chunks, joined, mix, runs_of
from admesh.llm.tables import table

SAMPLE = 5000  # labelled documents the fit may use
BITS = 18  # hashed features
FEATURES = 3000  # of them with a weight, for each scorer
CHUNK = 1_000_000  # bytes of text handled together
STEMS = (3, 4, 5, 6, 7, 8)  # bytes of a word's stem
REJECT = 0.4

# A public gazetteer of English insults; stems in other languages are learnt from labels.
INSULTS = ("idiot", "moron", "stupid", "scum", "trash", "loser", "clown", "pathetic", "worthless", "disgusting")

SHAPES = ("marks", "shout", "capitals", "pipes", "variety", "commonest", "length")
_MARKS = np.isin(np.arange(256), np.frombuffer(b"$&*#%", np.uint8))
_WORD = np.zeros(256, bool)
_WORD[128:] = _WORD[48:58] = _WORD[65:91] = _WORD[97:123] = True
_BINS = np.array([0.005, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8])


def _slot(hashes, kind):
    return (mix(hashes + np.uint64(kind * 0x51ED27)) >> np.uint64(64 - BITS)).astype(np.int64)


def shape_slots(shape: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each shape share's bin as a hashed feature: ``doc, slot``."""
    level = np.searchsorted(_BINS, shape, "right")
    key = np.uint64(1 << 40) + (np.arange(len(SHAPES)) * 64 + level).astype(np.uint64)
    return np.repeat(np.arange(len(shape)), len(SHAPES)), _slot(mix(key).ravel(), 99)


class Features:
    """Features of a chunk of texts: shape shares per text and hashed words and stems."""

    def __init__(self, texts: list[str]):
        self.n = len(texts)
        raw, at = joined([t.encode() for t in texts])
        size = np.maximum(np.diff(at) - 1, 1)

        def share(mask):
            return np.add.reduceat(mask.astype(np.int32), at[:-1]) / size if self.n else np.zeros(0)
        capital = (raw >= 65) & (raw <= 90)
        capital[1:] |= (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
        buffer, at = joined([t.lower().encode() for t in texts])
        starts, ends = runs_of(_WORD[buffer])
        self.doc = np.searchsorted(at, starts, "right") - 1
        hashes = RangeHashes(buffer)
        whole = hashes.of(starts, ends)
        self.words = np.bincount(self.doc, minlength=self.n)
        order = np.lexsort((whole, self.doc))
        doc, word = self.doc[order], whole[order]
        first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])])) if len(doc) else order
        counts = np.diff(np.append(first, len(doc)))
        distinct = np.bincount(doc[first], minlength=self.n)
        commonest = np.zeros(self.n)
        np.maximum.at(commonest, doc[first], counts)
        words = np.maximum(self.words, 1)
        self.shape = np.stack([
            share(_MARKS[raw]), share(raw == 33), share(capital), share(raw == 124),
            # A long text repeats words anyway, so distinct words are set against the square root of all.
            np.minimum(distinct / np.sqrt(words) / 10, 1), np.where(words >= 10, commonest / words, 0),
            np.minimum(size / 1000, 1)], 1)
        docs, ids = [doc[first]], [_slot(word[first], 0)]
        for stem in STEMS:
            long = ends - starts > stem
            docs.append(self.doc[long])
            ids.append(_slot(hashes.of(starts[long], starts[long] + stem), stem))
        self.token_doc, self.token = np.concatenate(docs), np.concatenate(ids)

    def distinct(self, chosen: np.ndarray, shapes: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of document and feature, each once, for the ``chosen`` features."""
        doc, slot = self.token_doc, self.token
        if shapes:
            more = shape_slots(self.shape)
            doc, slot = np.concatenate([doc, more[0]]), np.concatenate([slot, more[1]])
        kept = chosen[slot]
        pair = np.unique((doc[kept] << BITS) + slot[kept])
        return pair >> BITS, pair & ((1 << BITS) - 1)


def label_model(votes: np.ndarray, prior: float = 0.1, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of class 1 per row, and each labeller's accuracies, by EM.

    ``votes`` holds 1, 0, or -1 for an abstention; labellers are taken as
    independent given the class. ``accuracy[l, c, v]`` is the share of vote v
    (1, 0, abstain) of labeller l on class c. It starts from the assumption that
    labellers are mostly right, which also fixes which class is which.
    """
    n, count = votes.shape
    one_hot = np.stack([votes == 1, votes == 0, votes == -1], 2).astype(float)
    if not n:
        return np.zeros(0), np.full((count, 2, 3), 1 / 3)
    voted = one_hot[:, :, :2].sum(2)
    posterior = ((one_hot[:, :, 0].sum(1) + prior) / (voted.sum(1) + 1)).clip(0.01, 0.99)
    for _ in range(rounds):
        weight = np.stack([1 - posterior, posterior], 1)
        accuracy = np.einsum("nc,nlv->lcv", weight, one_hot) + 0.5
        accuracy /= accuracy.sum(2, keepdims=True)
        share = weight.mean(0).clip(1e-3, 1)
        log = np.log(share) + np.einsum("nlv,lcv->nc", one_hot, np.log(accuracy))
        posterior = 1 / (1 + np.exp((log[:, 0] - log[:, 1]).clip(-500, 500)))
    return posterior, accuracy


def fit_linear(doc, slot, target: np.ndarray, chosen: np.ndarray, rounds: int = 400, decay: float = 1e-3):
    """Logistic weights of the chosen features by gradient descent on soft labels: ``weights, bias``."""
    index = np.cumsum(chosen) - 1
    column, size, n = index[slot], int(chosen.sum()), len(target)
    weights, bias = np.zeros(size), float(np.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3)))
    moment, speed, moment_b, speed_b = np.zeros(size), np.zeros(size), 0.0, 0.0
    for step in range(1, rounds + 1):
        score = bias + np.bincount(doc, weights[column], minlength=n)
        error = 1 / (1 + np.exp(-score.clip(-50, 50))) - target
        slope = np.bincount(column, error[doc], minlength=size) / n + decay * weights
        slope_b = error.mean()
        moment, speed = 0.9 * moment + 0.1 * slope, 0.99 * speed + 0.01 * slope**2
        moment_b, speed_b = 0.9 * moment_b + 0.1 * slope_b, 0.99 * speed_b + 0.01 * slope_b**2
        rate, a, b = 0.05, 1 - 0.9**step, 1 - 0.99**step
        weights -= rate * (moment / a) / (np.sqrt(speed / b) + 1e-8)
        bias -= rate * (moment_b / a) / (np.sqrt(speed_b / b) + 1e-8)
    out = np.zeros(len(chosen))
    out[np.flatnonzero(chosen)] = weights
    return out, bias


def _odds(doc, slot, target):
    """Soft document counts of every feature on both classes."""
    yes, seen = np.zeros(1 << BITS), np.zeros(1 << BITS, np.int64)
    for lo in range(0, len(doc), 1 << 20):  # in parts, for their temporary weights and wide slots
        own = slot[lo:lo + (1 << 20)]
        yes += np.bincount(own, target[doc[lo:lo + (1 << 20)]], minlength=1 << BITS)
        seen += np.bincount(own, minlength=1 << BITS)
    return yes, seen - yes


def summarise(texts: list[str]) -> list[dict]:
    """What the fit needs of each text: word count, shape shares, and distinct hashed words and stems."""
    features = Features(texts)
    doc, slot = features.distinct(np.ones(1 << BITS, bool), shapes=False)
    slots = np.split(slot.astype(np.int32), np.searchsorted(doc, np.arange(1, len(texts))))
    return [{"words": int(w), "shape": s, "slots": t} for w, s, t in zip(features.words, features.shape, slots)]


def fit(sample: list[dict], quality: np.ndarray, toxic: np.ndarray) -> dict:
    """Scorers from summaries of a sample of texts and their noisy labels (-1: none).

    ``quality`` and ``toxic`` are 0 or 1. An empty sample gives scorers that
    keep everything.
    """
    slots = [r["slots"] for r in sample]
    return fit_columns(
        np.array([r["words"] for r in sample], np.int64), np.array([r["shape"] for r in sample]).reshape(-1, len(SHAPES)),
        np.concatenate([*slots, np.zeros(0, np.int32)]), np.array([len(s) for s in slots], np.int64), quality, toxic)


def fit_columns(words: np.ndarray, shape: np.ndarray, slot: np.ndarray, sizes: np.ndarray, quality: np.ndarray, toxic: np.ndarray) -> dict:
    """``fit`` of summaries as columns: all texts' slots in a row, with each text's number of them."""
    empty = {"weights": np.zeros(1 << BITS, np.float32), "bias": -10.0}
    if not len(words):
        return {"junk": empty, "toxic": empty, "accuracy": {}}
    doc = np.repeat(np.arange(len(words), dtype=np.int32), sizes)

    def votes(*labellers):
        return np.stack([np.where(bad, 1, np.where(good, 0, -1)) for bad, good in labellers], 1)
    marks, shout, capitals, pipes, variety, commonest, _ = shape.T
    clean = (marks < 0.005) & (shout < 0.005) & (pipes < 0.005)
    never = np.zeros(len(words), bool)
    junk, junk_accuracy = label_model(votes(
        (marks > 0.05, marks < 0.005), (shout > 0.05, shout < 0.005), (capitals > 0.4, capitals < 0.2),
        (pipes > 0.03, pipes < 0.005), (commonest > 0.3, commonest < 0.15),
        ((words >= 20) & (variety < 0.15), variety > 0.25), (never, clean & (commonest < 0.15)),
        (quality == 0, quality == 1)))

    def tied_to(target, share, precision):
        """Words and stems that a share of the target documents hold, and hardly any others.

        The share keeps out the words of a few copies of one document.
        """
        yes, no = _odds(doc, slot, target)
        return (yes >= max(4, share * target.sum())) & (yes >= precision * (yes + no))
    tied = tied_to((toxic == 1).astype(float), 0.03, 0.9)
    gazetteer = Features(list(INSULTS))
    insults = np.zeros(1 << BITS, bool)
    insults[gazetteer.token[:len(INSULTS)]] = True
    found = np.bincount(doc[tied[slot]], minlength=len(words))
    named = np.bincount(doc[insults[slot]], minlength=len(words))
    dense = found / np.maximum(np.sqrt(words), 1)
    foul, foul_accuracy = label_model(votes(
        (named >= 1, never), (found >= 2, found == 0), (dense > 0.3, dense < 0.02), (toxic == 1, toxic == 0)))

    def scorer(target, shapes):
        # Junk goes by shape alone: words of a language must not count against it.
        own_doc, own_slot = shape_slots(shape) if shapes else (doc, slot)
        yes, no = _odds(own_doc, own_slot, target)
        share = max(target.mean(), 1e-6)
        seen = yes + no
        gain = np.abs(yes - share * seen) / np.sqrt(share * (1 - share) * seen + 1)
        if not shapes:  # only evidence for the class; common words say nothing about it
            gain = np.where(tied_to(target, 0.02, 0.85), gain, 0)
        chosen = np.zeros(1 << BITS, bool)
        best = np.argsort(-gain, kind="stable")[:FEATURES]
        chosen[best[gain[best] > (0 if shapes else 3)]] = True
        kept = chosen[own_slot]
        weights, bias = fit_linear(own_doc[kept], own_slot[kept], target, chosen)
        if not shapes:
            weights = np.maximum(weights, 0)
        return {"weights": weights.astype(np.float32), "bias": float(bias)}

    return {"junk": scorer(junk, True), "toxic": scorer(foul, False),
            "accuracy": {"junk": junk_accuracy, "toxic": foul_accuracy}}


def score(model: dict, texts: list[str]) -> dict[str, np.ndarray]:
    """Probability of each cause of rejection for every text."""
    features = Features(texts)
    out = {}
    for name in ("junk", "toxic"):
        weights = model[name]["weights"].astype(float)
        doc, slot = features.distinct(weights != 0, shapes=name == "junk")
        total = model[name]["bias"] + np.bincount(doc, weights[slot], minlength=len(texts))
        out[name] = 1 / (1 + np.exp(-np.clip(total, -50, 50)))
    return out


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """Fit on at most ``sample`` labelled documents, or unlabelled ones if none has a label.

    The sample takes the smallest hashes of the ids, so it does not depend on
    the tables' partitioning. Several label rows of a document count as their
    worst, several rows of an id as one; rows with a null id are left out of the
    fit. Texts stay on the executors; the driver gets their summaries.
    """
    def chosen(ids):
        return F.broadcast(ids.filter(F.col("doc_id").isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    own = docs.select("doc_id", "text")
    named = chosen(labels.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")))
    known = own.join(named, "doc_id")
    if not known.head(1):
        known = own.join(chosen(own.select("doc_id").distinct()), "doc_id").select(
            "*", F.lit(None).cast("int").alias("quality"), F.lit(None).cast("int").alias("toxic"))

    def run(batches):
        for part in chunks(batches, CHUNK):
            rows = summarise([t or "" for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_pylist(
                [{"doc_id": i, "quality": q, "toxic": t} | r for i, q, t, r in zip(
                    *(part.column(c).to_pylist() for c in ("doc_id", "quality", "toxic")), rows)], schema)
    schema = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32()), ("words", pa.int64()),
                        ("shape", pa.list_(pa.float64())), ("slots", pa.list_(pa.int32()))])
    summary = known.mapInArrow(run, "doc_id bigint, quality int, toxic int, words bigint, shape array<double>, "
                                    "slots array<int>").toArrow().sort_by("doc_id")
    ids = summary.column("doc_id").to_numpy()
    first = np.flatnonzero(np.diff(ids, prepend=ids[:1] - 1)) if len(ids) else ids  # one row of a repeated id
    summary = summary.take(first)

    def column(name):
        return summary.column(name).fill_null(-1).to_numpy()
    slots = summary.column("slots").combine_chunks()
    model = fit_columns(
        column("words"), summary.column("shape").combine_chunks().flatten().to_numpy().reshape(-1, len(SHAPES)),
        slots.flatten().to_numpy(), slots.value_lengths().to_numpy(), column("quality"), column("toxic"))
    del summary, slots
    pa.default_memory_pool().release_unused()  # else the driver holds the summaries' memory to its end
    return model


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, reject: float = REJECT) -> DataFrame:
    """All rows and columns of ``docs`` with ``kept``, ``junk`` and ``toxic``.

    ``junk`` and ``toxic`` are the scorers' probabilities, ``kept`` says that
    both are below ``reject``. Columns of those names are replaced. A null text
    is judged as empty; every input row gives one row, repeated ones included.
    """
    docs = docs.drop("junk", "toxic", "kept")
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))
    more = T.StructType().add("junk", "double").add("toxic", "double").add("kept", "boolean")
    schema = T.StructType(docs.schema.fields + more.fields)

    def run(batches: Iterator[pa.RecordBatch]):
        for part in chunks(batches, CHUNK):
            scores = score(model.value, [t or "" for t in part.column("text").to_pylist()])
            kept = (scores["junk"] < reject) & (scores["toxic"] < reject)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(scores["junk"]), pa.array(scores["toxic"]), pa.array(kept)],
                [*part.schema.names, "junk", "toxic", "kept"])

    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, unchanged, also in columns that ``judge`` would replace."""
    aside = {}
    for name in ("junk", "toxic", "kept"):
        if name in docs.columns:
            aside[name] = name + "_"
            while aside[name] in docs.columns:
                aside[name] += "_"
    kept = judge(docs.withColumnsRenamed(aside), labels, sample).filter("kept").drop("junk", "toxic", "kept")
    return kept.withColumnsRenamed({new: old for old, new in aside.items()}).select(*docs.columns)


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that the classifier keeps, with its probabilities of junk and toxicity."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    judged = judge(docs, table(spark, folder, "labels"))
    return judged.filter("kept").select("doc_id", F.round("junk", 6).alias("junk"),
                                        F.round("toxic", 6).alias("toxic"), "kept")
