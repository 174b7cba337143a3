"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every token is masked once and predicted from the two tokens on either side; the
sum of the conditional log-probabilities scores the document. Tokens are words.
A table counts every word of the corpus by its 32-bit hash; the words are laid
into slots whose number grows with the table, two per word at least, up to
``SLOTS``. So a word is itself up to millions of words, and rare words share
slots beyond.

The network is a hierarchical softmax over the context's hidden layer: it
predicts a class, then a leaf of that class, and the slot follows from its share
of the leaf. The most frequent slots have a class or a leaf of their own, the
rest are dealt to the other leaves. A context enters through one embedding table
per offset, with a row of its own for each frequent word and hashed rows for the
others. Both softmaxes depend on the context, so the probabilities of all slots
add up to one and swapping two rare words changes the score.

It is trained in numpy where the data lies, on every token: in each round every
task starts from the same weights, runs gradient descent over its part of the
corpus and hands on the blocks of weights it changed. Each block is averaged over
the tasks that changed it, as whole numbers, so the average does not depend on
order. What reaches the driver is bounded by the slots and the network.
"""

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admesh.llm.rolling import RangeHashes, chunks, joined, runs_of
from admesh.llm.tables import documents
from admesh.storage import RunFolder

SLOTS = 1 << 22  # the most slots, whose counts reach the driver and all tasks
CLASSES = 64
ALONE = 16  # classes of one frequent slot each
LEAVES = 64  # of every other class
OWN = 48  # leaves of one slot each
ROWS = 4_096  # embeddings of words for each offset,
OWN_ROWS = 3_072  # of which so many belong to one slot each
HIDDEN = 32
OFFSETS = (-2, -1, 1, 2)
ROUNDS = 2
BATCH = 4_096  # tokens trained on or scored together
RATE = 0.07
CHUNK = 2_000_000
LIMIT = np.float32(60)  # of a logit, where
MOST = 1e27  # of a row's exponentials does not suffice
TASK = 1_000_000  # tokens that a task trains on at least, where that leaves a task for every core
BLOCK = 32  # weights averaged together
_SCALE = 1 << 20
_SLICE = 4_096  # blocks handed on together
_SMALL = 256  # rows multiplied at once: BLAS takes small products as they lie, and repacks large ones

_WORD = np.zeros(256, bool)
_WORD[128:] = _WORD[48:58] = _WORD[65:91] = _WORD[97:123] = True


def tokens(texts: list[str]) -> list[np.ndarray]:
    """The 32-bit hashes of every text's words, lower-cased runs of letters and digits."""
    buffer, at = joined([t.lower().encode() for t in texts])
    starts, ends = runs_of(_WORD[buffer])
    hashes = (RangeHashes(buffer).of(starts, ends) >> np.uint64(32)).astype("<u4")
    return np.split(hashes, np.searchsorted(starts, at[1:-1])) if texts else []


def tokenize(docs: DataFrame) -> DataFrame:
    """``doc_id`` and its word hashes as little-endian 32-bit numbers; a null text has none."""
    def run(batches: Iterator[pa.RecordBatch]):
        for part in chunks(batches, CHUNK):
            found = tokens([t or "" for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([s.tobytes() for s in found], pa.binary())], ["doc_id", "words"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, words binary")


def word_counts(tokenized: DataFrame, held: int = 1_000_000) -> DataFrame:
    """``word, n`` of every word of the corpus; a task sums up ``held`` words at a time."""
    def run(batches):
        word, n = np.zeros(0, np.uint32), np.zeros(0, np.int64)

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(n)], ["word", "n"])
        for batch in batches:
            for part in chunks(iter([batch]), 8 * CHUNK, "words"):
                new, count = np.unique(np.frombuffer(b"".join(part.column("words").to_pylist()), "<u4"), return_counts=True)
                word, at = np.unique(np.concatenate([word, new]), return_inverse=True)
                n = np.bincount(at, np.concatenate([n, count]), minlength=len(word)).astype(np.int64)
                if len(word) > held:
                    yield rows()
                    word, n = word[:0], n[:0]
        if len(word):
            yield rows()
    return tokenized.select("words").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def slot_counts(words: DataFrame, most: int = SLOTS) -> np.ndarray:
    """How often the words of each slot occur; two slots for every word, at least 65,536, up to ``most``."""
    bits = min(max(math.ceil(math.log2(max(2 * words.count(), 1))), 16), int(math.log2(most)))
    counted = words.groupBy(F.shiftright("word", 32 - bits).alias("slot")).agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << bits, np.int64)
    out[counted.column("slot").to_numpy()] = counted.column("n").to_numpy()
    return out


class Lexicon(NamedTuple):
    """For each slot its class, its leaf in the class, the logarithm of its share of the leaf, and its embedding row."""

    class_: np.ndarray
    leaf: np.ndarray
    share: np.ndarray
    row: np.ndarray

    def slots(self, words: np.ndarray) -> np.ndarray:
        return words >> np.uint32(32 - int(math.log2(len(self.share))))

    def packed(self) -> np.ndarray:
        """All four side by side, so that a token costs one access to a table beyond the cache."""
        out = np.empty(len(self.share), ENTRY)
        out["class_"], out["leaf"], out["share"], out["row"] = self
        return out


ENTRY = np.dtype([("share", np.float32), ("row", np.uint16), ("class_", np.uint8), ("leaf", np.uint8)])


def lexicon(counts: np.ndarray) -> Lexicon:
    """Deal the slots out by their counts.

    The ``ALONE`` most frequent have a class each. The next go to the other
    classes in turns, one leaf a turn for ``OWN`` turns; the rest take turns over
    the leaves that are left, so that classes weigh about the same.
    """
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    width = CLASSES - ALONE
    turn, place = (rank - ALONE) // width, (rank - ALONE) % width
    alone = rank < ALONE
    class_ = np.where(alone, rank, ALONE + np.where(turn % 2 == 0, place, width - 1 - place)).astype(np.uint8)
    leaf = np.where(alone, 0, np.where(turn < OWN, turn, OWN + (turn - OWN) % (LEAVES - OWN))).astype(np.uint8)
    smoothed = counts + 0.1
    whole = class_.astype(np.int64) * LEAVES + leaf
    share = np.log(smoothed / np.bincount(whole, smoothed, minlength=CLASSES * LEAVES)[whole]).astype(np.float32)
    row = np.where(rank < OWN_ROWS, rank, OWN_ROWS + rank % (ROWS - OWN_ROWS)).astype(np.uint16)
    return Lexicon(class_, leaf, share, row)


def initial(counts: np.ndarray, words: Lexicon) -> dict[str, np.ndarray]:
    """Fixed random weights; both softmaxes start at the shares of classes and leaves."""
    r = np.random.default_rng(1)
    whole = words.class_.astype(np.int64) * LEAVES + words.leaf
    totals = np.bincount(whole, counts + 0.1, minlength=CLASSES * LEAVES).reshape(CLASSES, LEAVES) + 1e-6
    return {"embed": (r.standard_normal((len(OFFSETS), ROWS + 1, HIDDEN)) * 0.1).astype(np.float32),
            "hidden": np.zeros(HIDDEN, np.float32),
            "out": (r.standard_normal((HIDDEN, CLASSES)) * 0.1).astype(np.float32),
            "bias": np.log(totals.sum(1) / totals.sum()).astype(np.float32),
            "deep": (r.standard_normal((CLASSES, HIDDEN, LEAVES)) * 0.1).astype(np.float32),
            "deep_bias": np.log(totals / totals.sum(1, keepdims=True)).astype(np.float32)}


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    """All weights in a row, filled up to whole blocks."""
    line = np.concatenate([w.ravel() for w in weights.values()])
    return np.concatenate([line, np.zeros(-len(line) % BLOCK, np.float32)])


def shaped(values: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, w in like.items():
        out[name] = values[at:at + w.size].reshape(w.shape).astype(np.float32)
        at += w.size
    return out


class Tokens(NamedTuple):
    """Tokens in a row: what is predicted, and the rows of the neighbours (``ROWS`` beyond a text's ends)."""

    class_: np.ndarray
    leaf: np.ndarray
    around: np.ndarray
    share: np.ndarray

    def part(self, lo: int, size: int) -> "Tokens":
        return Tokens(self.class_[lo:lo + size], self.leaf[lo:lo + size], self.around[:, lo:lo + size], self.share[lo:lo + size])


def in_context(texts: list[np.ndarray], entries: np.ndarray) -> Tokens:
    """The tokens of all texts, given as word hashes and a packed lexicon."""
    reach = max(OFFSETS)
    sizes = np.array([len(t) for t in texts], np.int64)
    words = np.concatenate([*texts, np.zeros(0, np.uint32)])
    found = entries.take(words >> np.uint32(32 - int(math.log2(len(entries)))))
    at = np.arange(len(found)) + reach * (1 + np.repeat(np.arange(len(texts)), sizes))
    line = np.full(len(found) + reach * (len(texts) + 1), ROWS, np.uint16)
    line[at] = found["row"]
    around = np.stack([line[at + o] for o in OFFSETS]) if len(at) else np.zeros((len(OFFSETS), 0), np.uint16)
    return Tokens(found["class_"].copy(), found["leaf"].copy(), around, found["share"].copy())


def activation(first: np.ndarray, embed: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hidden layer, a row for each token, and the same with a last column of ones for the biases.

    ``rows`` are those of all tokens for each offset: of ``first``, which has the
    layer's bias added, for the first offset, and of ``embed`` for the others.
    """
    total = first.take(rows[0], axis=0)
    for some in rows[1:]:
        total += embed.take(some, axis=0)
    np.tanh(total, out=total)
    out = np.ones((len(total), HIDDEN + 1), np.float32)
    out[:, :-1] = total
    return total, out


def _layers(weights) -> tuple[np.ndarray, np.ndarray]:
    """Both softmax layers with their biases as a last row."""
    return (np.vstack([weights["out"], weights["bias"]]),
            np.concatenate([weights["deep"], weights["deep_bias"][:, None]], 1))


def _exp(logits: Callable[[], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The exponentials and their sums by row; logits are clipped where a sum could overflow or vanish."""
    out = logits()
    ones = np.ones((out.shape[1], 1), np.float32)
    with np.errstate(over="ignore"):
        np.exp(out, out=out)
        total = out @ ones
    if len(out) and not (total.min() > 1 / MOST and total.max() < MOST):
        out = logits()
        np.clip(out, -LIMIT, LIMIT, out=out)
        np.exp(out, out=out)
        total = out @ ones
    return out, total


def _cut(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows in slices of ``_SMALL``, and those that are left."""
    whole = len(a) // _SMALL * _SMALL
    return a[:whole].reshape(-1, _SMALL, a.shape[1]), a[whole:]


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of a long ``a``."""
    out = np.empty((len(a), b.shape[1]), np.float32)
    for some, to in zip(_cut(a), _cut(out)):
        np.matmul(some, b, out=to)
    return out


def _over_rows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` of long ``a`` and ``b``."""
    (a, last_a), (b, last_b) = _cut(a), _cut(b)
    return np.matmul(a.transpose(0, 2, 1), b).sum(0) + last_a.T @ last_b


def _places(columns: np.ndarray, width: int) -> np.ndarray:
    """Where one column of each row lies in a table of that width, its rows laid end to end."""
    return np.arange(0, len(columns) * width, width) + columns


def _by_class(own: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """An order of the tokens by class; their classes, leaves and neighbours in it, rows of the embeddings of all offsets in one table."""
    order = np.argsort(own.class_, kind="stable")
    rows = own.around.take(order, axis=1) + np.arange(0, len(OFFSETS) * (ROWS + 1), ROWS + 1)[:, None]
    return order, own.class_.take(order), own.leaf.take(order), rows


def _ranges(ordered: np.ndarray) -> tuple[int, list[tuple[int, int, int]]]:
    """Where the classes of several leaves begin among ordered classes, and the range of each from there, if it occurs."""
    ends = np.searchsorted(ordered, np.arange(ALONE, CLASSES + 1))
    first, ends = int(ends[0]), (ends - ends[0]).tolist()
    return first, [(c, lo, hi) for c, lo, hi in zip(range(ALONE, CLASSES), ends, ends[1:]) if lo < hi]


def _leaf_logits(near: np.ndarray, deep: np.ndarray, ranges: list[tuple[int, int, int]]) -> np.ndarray:
    out = np.empty((len(near), LEAVES), np.float32)
    for c, lo, hi in ranges:
        np.matmul(near[lo:hi], deep[c], out=out[lo:hi])
    return out


def token_scores(weights, every: Tokens) -> np.ndarray:
    """Log-probability of every token given its neighbours."""
    layer, deep = _layers(weights)
    embed = weights["embed"].reshape(-1, HIDDEN)
    biased = weights["embed"][0] + weights["hidden"]
    out = np.empty(len(every.class_), np.float32)
    for lo in range(0, len(out), BATCH):
        own = every.part(lo, BATCH)
        order, class_, leaf, rows = _by_class(own)
        first, ranges = _ranges(class_)
        _, hidden = activation(biased, embed, rows)
        weight, total = _exp(lambda: _times(hidden, layer))
        near = weight.take(_places(class_, CLASSES)) / total[:, 0]
        weight, total = _exp(lambda: _leaf_logits(hidden[first:], deep, ranges))
        near[first:] *= weight.take(_places(leaf[first:], LEAVES)) / total[:, 0]
        out[lo + order] = np.log(np.maximum(near, np.float32(1e-37))) + own.share.take(order)
    return out


def descend(weights, every: Tokens, rate: float) -> None:
    """One pass of gradient descent over the tokens, in place, in batches.

    A weight moves by the sum of the slopes of the n tokens of the batch that it
    takes part in, over the square root of n.
    """
    layer, deep = _layers(weights)
    embed = weights["embed"].reshape(-1, HIDDEN)
    whole = embed.view(f"V{embed.itemsize * HIDDEN}")[:, 0]  # a row is one value, which is faster to put back
    place = np.empty(len(embed), np.intp)
    for at in range(0, len(every.class_), BATCH):
        # In the order of classes, a class's tokens are a slice, and so are those of all classes of several leaves.
        _, class_, leaf, rows = _by_class(every.part(at, BATCH))
        first, ranges = _ranges(class_)
        size = len(class_)
        step = np.float32(rate / math.sqrt(size))
        n = np.bincount(rows.ravel(), minlength=len(embed))
        found = np.flatnonzero(n > 0)  # the embeddings that occur, side by side
        place[found] = np.arange(len(found))
        rows = place.take(rows)
        used = embed.take(found, axis=0)
        units, hidden = activation(used[:rows[0].max() + 1] + weights["hidden"], used, rows)
        error, total = _exp(lambda: _times(hidden, layer))
        error *= 1 / total
        error.reshape(-1)[_places(class_, CLASSES)] -= 1
        back = _times(error, layer[:-1].T.copy())
        layer -= step * _over_rows(hidden, error)
        near = hidden[first:]
        wrong, total = _exp(lambda: _leaf_logits(near, deep, ranges))
        wrong *= 1 / total
        wrong.reshape(-1)[_places(leaf[first:], LEAVES)] -= 1
        below = np.empty((len(near), HIDDEN), np.float32)
        for c, lo, hi in ranges:
            some, own = wrong[lo:hi], deep[c]
            np.matmul(some, own[:-1].T, out=below[lo:hi])
            slope = near[lo:hi].T @ some
            slope *= rate / math.sqrt(hi - lo)
            own -= slope
        back[first:] += below
        np.square(units, out=units)
        back *= np.subtract(1, units, out=units)
        weights["hidden"] -= step * (np.ones(size, np.float32) @ back)
        # Two units are summed at once, as the parts of a complex number.
        across = np.ascontiguousarray(back.view(np.complex64).T)
        slopes = np.zeros((len(across), len(found)), np.complex64)
        for some, units in zip(slopes, across):
            for of_offset in rows:
                np.add.at(some, of_offset, units)
        scaled = slopes.view(np.float32)
        scaled *= np.repeat((rate / np.sqrt(n.take(found))).astype(np.float32), 2)
        pairs = used.view(np.complex64)
        pairs -= slopes.T
        whole[found] = used.view(whole.dtype)[:, 0]
    weights["out"], weights["bias"] = layer[:-1].copy(), layer[-1].copy()
    weights["deep"], weights["deep_bias"] = deep[:, :-1].copy(), deep[:, -1].copy()


def _texts(batches) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for part in chunks(iter([batch]), CHUNK, "words"):
            yield part, [np.frombuffer(s, "<u4") for s in part.column("words").to_pylist()]


def train(tokenized: DataFrame, words: Lexicon, counts: np.ndarray, rounds: int = ROUNDS) -> dict:
    """Weights averaged over the tasks after each round of local descent."""
    weights = initial(counts, words)
    sc = tokenized.sparkSession.sparkContext
    # A few documents alone make a poor local model, and every task hands on all weights that it moved.
    texts = tokenized.select("words").coalesce(max(sc.defaultParallelism, int(counts.sum()) // TASK, 1))
    dealt = sc.broadcast(words.packed())
    for round_ in range(rounds):
        shared = sc.broadcast(weights)

        def run(batches, rate=RATE / (1 + round_)):
            own = {k: v.copy() for k, v in shared.value.items()}
            for _, texts in _texts(batches):
                descend(own, in_context(texts, dealt.value), rate)
            before, after = flat(shared.value).reshape(-1, BLOCK), flat(own).reshape(-1, BLOCK)
            moved = np.flatnonzero((before != after).any(1))
            for lo in range(0, len(moved), _SLICE):
                some = moved[lo:lo + _SLICE]
                values = np.clip(np.round(after[some].astype(np.float64) * _SCALE), -2**31, 2**31 - 1).astype("<i4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), pa.array([v.tobytes() for v in values], pa.binary())], ["block", "data"])

        def average(batches):
            # Blocks arrive in order, so one sum is held at a time.
            out: dict[str, list] = {"block": [], "n": [], "data": []}
            block, n, total = None, 0, None
            for batch in batches:
                for b, data in zip(batch.column("block").to_pylist(), batch.column("data").to_pylist()):
                    if b != block:
                        if block is not None:
                            _add(out, block, n, total)
                        block, n, total = b, 0, np.zeros(BLOCK, np.int64)
                    n += 1
                    total = total + np.frombuffer(data, "<i4")
            if block is not None:
                _add(out, block, n, total)
            yield pa.RecordBatch.from_pydict(out, pa.schema([("block", pa.int64()), ("n", pa.int64()), ("data", pa.binary())]))
        averaged = (
            texts.mapInArrow(run, "block bigint, data binary")
            .repartition("block").sortWithinPartitions("block").mapInArrow(average, "block bigint, n bigint, data binary").toArrow())
        if averaged.num_rows:
            line = flat(weights).astype(np.float64).reshape(-1, BLOCK)
            sums = np.frombuffer(b"".join(averaged.column("data").to_pylist()), "<i8").reshape(-1, BLOCK)
            line[averaged.column("block").to_numpy()] = sums / averaged.column("n").to_numpy()[:, None] / _SCALE
            weights = shaped(line.ravel(), weights)
        shared.destroy()
    dealt.destroy()
    return weights


def _add(out: dict[str, list], block: int, n: int, total: np.ndarray) -> None:
    for name, value in zip(out, (block, n, total.tobytes())):
        out[name].append(value)


def score_documents(docs: DataFrame, run_folder: RunFolder) -> DataFrame:
    """``doc_id, n_tokens, log_likelihood, mean_log_likelihood`` of every row of ``doc_id, text``.

    Trained on the same documents, all of them. A text without words, or null,
    has no tokens, a log-likelihood of 0 and a null mean. Every input row gives
    one row; other columns are ignored.
    """
    tokenized = run_folder.write(tokenize(docs), "tokens")
    counts = slot_counts(run_folder.write(word_counts(tokenized), "words"))
    words = lexicon(counts)
    weights = train(tokenized, words, counts)
    model = tokenized.sparkSession.sparkContext.broadcast((weights, words.packed()))

    def run(batches):
        weights, entries = model.value
        for part, texts in _texts(batches):
            line = token_scores(weights, in_context(texts, entries)).astype(np.float64)
            sizes = np.array([len(t) for t in texts], np.int64)
            sums = np.concatenate([[0.0], np.cumsum(line)])
            ends = np.cumsum(sizes)
            total = sums[ends] - sums[ends - sizes]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes), pa.array(np.where(sizes > 0, total, 0.0)),
                 pa.array(total / np.maximum(sizes, 1), mask=sizes == 0)],
                ["doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood"])
    return tokenized.mapInArrow(
        run, "doc_id bigint, n_tokens bigint, log_likelihood double, mean_log_likelihood double")


def op8_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's masked pseudo-likelihood."""
    return score_documents(documents(spark, folder), RunFolder(spark))
