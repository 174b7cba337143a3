"""Suffix-sorted removal of repeated substrings.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts
earlier, in a document with a smaller id or earlier in the same one.

*Anchors.* The smallest hash among the ``GRAM``-byte substrings of a window of
``LENGTH`` bytes names the window's anchor. Equal windows have equal anchors at
equal offsets, so only suffixes around the same anchor need sorting. Windows in
a row that share an anchor form a run.

*Shards.* Runs with equal bytes collapse to the earliest one, first within a map
task, then per anchor; the windows of the others are repeats. Anchors that are
left with different runs form the shards.

*Induced sorting.* In a shard the suffixes at the anchors are sorted, with the
common prefix of neighbours. Sorting them one byte further left is induced: a
suffix's place follows from its new first byte and its place before, and a
common prefix is one byte longer than the smallest one between the old places.
Tuples of class, common prefix, position and bytes to the left pass from level
to level through a priority queue that moves blocks to disk beyond a bound, so a
shard may exceed memory. At every level, suffixes whose common prefixes reach
``LENGTH`` are equal windows. A class of one leaves the queue.

An anchor with very many different runs (a line that many documents share) is
dealt out by the bytes of each single window before it is sorted. A map task
folds its equal windows to the earliest; the others are repeats. So a group that
is sorted together has ``HOT`` runs at most, or a window for each batch that a
map task folds, however often a line occurs.
"""

import hashlib
import heapq
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admesh.llm.rolling import RangeHashes, chunks, joined
from admesh.llm.tables import documents
from admesh.storage import RunFolder

LENGTH = 100
GRAM = 20
CHUNK = 1_000_000  # bytes of text handled together
HELD = 2_000_000  # runs that a map task folds at a time
HOT = 20_000  # different runs of an anchor that one task sorts
FOLDED = 100_000  # different windows of hot anchors that a map task folds at a time
BLOCK = 20_000  # tuples of a queue block
MEMORY = 64_000_000  # bytes of tuples the queue holds before it uses the disk

KEYS = "h bigint, run bigint, doc_id bigint, at bigint, stop bigint"
FOUND = "h bigint, doc_id bigint, at bigint, stop bigint"
SUFFIXES = "h bigint, part bigint, doc_id bigint, start bigint, windows int, left int, bytes binary"
SPANS = "doc_id bigint, at bigint, stop bigint"


def anchored_runs(texts: list[bytes], length: int, gram: int):
    """Runs of windows with a common anchor: anchor hash, run hash, text, start, windows, anchor's offset."""
    buffer, at = joined(texts)
    width = length - gram + 1
    if len(buffer) < length:
        return [np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64)]
    hashes = RangeHashes(buffer)
    here = np.arange(len(buffer) - gram + 1)
    grams = hashes.of(here, here + gram)
    low, where, size = grams, here.astype(np.int32), 1

    def fold(low, where, step):
        less = low[step:] < low[:-step]  # the leftmost of equals stays
        return np.where(less, low[step:], low[:-step]), np.where(less, where[step:], where[:-step])
    while size * 2 <= width:
        low, where = fold(low, where, size)
        size *= 2
    if width > size:
        low, where = fold(low, where, width - size)
    doc = np.repeat(np.arange(len(texts)), np.diff(at))[:len(where)]
    change = np.flatnonzero(np.concatenate([[True], (where[1:] != where[:-1]) | (doc[1:] != doc[:-1])]))
    end = np.append(change[1:], len(where))
    end = np.minimum(end, at[doc[change] + 1] - length)  # windows end within the text
    kept = end > change
    start, end = change[kept], end[kept]
    anchor = where[start].astype(np.int64)
    return (grams[anchor], hashes.of(start, end + length - 1), doc[start], start - at[doc[start]], end - start,
            anchor - start)


def _pack(start, windows, left):
    return start << 16 | windows << 8 | left


def _unpack(at):
    return at >> 16, at >> 8 & 255, at & 255


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges as maximal ranges in order."""
    if not len(starts):
        return starts, stops
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    first = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[first], reach[np.append(np.flatnonzero(first)[1:] - 1, len(reach) - 1)]


def _fold_runs(h, run, doc, at, length):
    """One key row per distinct run, the earliest; the windows of the others as merged ranges."""
    order = np.lexsort((at, doc, run, h))
    h, run, doc, at = h[order], run[order], doc[order], at[order]
    first = np.concatenate([[True], (h[1:] != h[:-1]) | (run[1:] != run[:-1])])
    same = np.concatenate([[False], (doc[1:] == doc[:-1]) & (at[1:] == at[:-1])]) & ~first
    rest = ~first & ~same
    start, windows, _ = _unpack(at[rest])
    owner = doc[rest]
    # Ranges of different documents are kept apart by an offset larger than any text.
    names, index = np.unique(owner, return_inverse=True)
    wide = np.int64((start + windows).max() + 2 * length if len(start) else 1)
    lo, hi = merged(start + index * wide, start + windows - 1 + length + index * wide)
    which = lo // wide
    keys = [h[first].view(np.int64), run[first].view(np.int64), doc[first], at[first]]
    return keys, [names[which] if len(which) else which, lo - which * wide, hi - which * wide]


def _keys(docs: DataFrame, length: int, gram: int) -> DataFrame:
    names = ["h", "run", "doc_id", "at", "stop"]

    def run(batches: Iterator[pa.RecordBatch]):
        held, count = [], 0

        def flush():
            keys, (doc, lo, hi) = _fold_runs(*(np.concatenate(c) for c in zip(*held)), length)
            yield pa.RecordBatch.from_arrays([*map(pa.array, keys), pa.nulls(len(keys[0]), pa.int64())], names)
            yield pa.RecordBatch.from_arrays(  # any h that spreads them over the tasks
                [pa.array(doc * 0x9E3779B1 + lo), pa.nulls(len(doc), pa.int64()), pa.array(doc), pa.array(lo),
                 pa.array(hi)], names)
        for part in chunks(batches, CHUNK):
            ids = part.column("doc_id").to_numpy()
            h, r, doc, start, windows, left = anchored_runs(
                part.column("text").cast(pa.binary()).to_pylist(), length, gram)
            held.append((h, r, ids[doc], _pack(start, windows, left)))
            count += len(h)
            if count > HELD:
                yield from flush()
                held, count = [], 0
        if count:
            yield from flush()
    return docs.mapInArrow(run, KEYS)


def _classify(keys: DataFrame, length: int) -> DataFrame:
    """Ranges of repeated runs (``stop`` set), and the different runs of an anchor that has several."""
    names = ["h", "doc_id", "at", "stop"]

    def run(batches):
        last, pending, several = None, None, False  # the open anchor's first run until a second one comes
        for batch in batches:
            known = np.asarray(batch.column("stop").is_valid())
            ready = batch.filter(pa.array(known))
            if ready.num_rows:
                yield ready.select(names)
            h, r, doc, at = (batch.filter(pa.array(~known)).column(c).to_numpy() for c in ("h", "run", "doc_id", "at"))
            if not len(h):
                continue
            new_h, new_r = np.ones(len(h), bool), np.ones(len(h), bool)
            same = np.zeros(len(h), bool)
            new_h[1:] = h[1:] != h[:-1]
            new_r[1:] = new_h[1:] | (r[1:] != r[:-1])
            same[1:] = (doc[1:] == doc[:-1]) & (at[1:] == at[:-1])
            if last is not None:
                new_h[0] = h[0] != last[0]
                new_r[0] = new_h[0] or r[0] != last[1]
                same[0] = (doc[0], at[0]) == last[2:]
            group = np.cumsum(new_h)
            several_here = np.bincount(group, new_r).astype(np.int64)
            several_here[0] += (pending is not None or several) and not new_h[0]
            repeat = ~new_r & ~same
            start, windows, _ = _unpack(at[repeat])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[repeat]), pa.array(doc[repeat]), pa.array(start), pa.array(start + windows - 1 + length)], names)
            if not new_h[0] and several_here[0] >= 2:
                if pending is not None:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x], pa.int64()) for x in (pending[0], *pending[2:])] + [pa.nulls(1, pa.int64())], names)
                pending, several = None, True
            differ = new_r & (several_here[group] >= 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[differ]) for x in (h, doc, at)] + [pa.nulls(int(differ.sum()), pa.int64())], names)
            if new_h.any():
                i = int(np.flatnonzero(new_h)[-1])
                several = bool(several_here[group[-1]] >= 2)
                pending = None if several else (int(h[i]), int(r[i]), int(doc[i]), int(at[i]))
            last = (int(h[-1]), int(r[-1]), int(doc[-1]), int(at[-1]))
    return keys.repartition("h").sortWithinPartitions("h", "run", "doc_id", "at").mapInArrow(run, FOUND)


class _Windows:
    """Folds equal windows of hot anchors: the earliest of each, and the others as repeats."""

    def __init__(self):
        self.first: dict[tuple[int, bytes], tuple[int, int, int]] = {}
        self.repeats: set[tuple[int, int]] = set()

    def __len__(self):
        return len(self.first) + len(self.repeats)

    def add(self, h: int, own: bytes, doc: int, start: int, left: int) -> None:
        before = self.first.setdefault((h, own), (doc, start, left))
        if (doc, start) < before[:2]:
            self.first[h, own] = doc, start, left
            self.repeats.add(before[:2])
        elif (doc, start) > before[:2]:
            self.repeats.add((doc, start))

    def rows(self) -> Iterator[tuple]:
        """Rows of ``SUFFIXES``; a negative number of windows marks so many repeats from ``start`` on."""
        for (h, own), (doc, start, left) in self.first.items():
            deal = int.from_bytes(hashlib.blake2b(own, digest_size=8).digest(), "big", signed=True)
            yield h, deal, doc, start, 1, left, own
        at = n = 0
        last = None
        for doc, start in sorted(self.repeats):
            if last != doc or start != at + n:
                if n:
                    yield last, at, last, at, -n, 0, b""  # any group that spreads them over the tasks
                last, at, n = doc, start, 0
            n += 1
        if n:
            yield last, at, last, at, -n, 0, b""


def _suffixes(docs: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """The bytes of the runs that a shard has to sort; a hot anchor's runs window by window, equal ones folded."""
    def run(batches):
        folded = _Windows()
        for part in chunks(batches, CHUNK):
            rows = []
            for doc_id, text, runs in zip(*(part.column(c) for c in ("doc_id", "text", "runs"))):
                doc, text = doc_id.as_py(), text.as_py().encode()
                for r in runs.as_py():
                    start, windows, left = _unpack(r["at"])
                    if not r["hot"]:
                        rows.append((r["h"], 0, doc, start, windows, left, text[start:start + length + windows - 1]))
                        continue
                    for s in range(start, start + windows):
                        folded.add(r["h"], text[s:s + length], doc, s, left - (s - start))
                    if len(folded) >= FOLDED:
                        yield _suffix_batch(folded.rows())
                        folded = _Windows()
            yield _suffix_batch(rows)
        yield _suffix_batch(folded.rows())
    hot = asked.groupBy("h").count().filter(F.col("count") > HOT).select("h", F.lit(True).alias("hot"))
    runs = (
        asked.join(hot, "h", "left")
        .groupBy("doc_id").agg(F.collect_list(F.struct("h", "at", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("runs")))
    return docs.join(runs, "doc_id").mapInArrow(run, SUFFIXES)


_SUFFIX = pa.schema([("h", pa.int64()), ("part", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()),
                     ("windows", pa.int32()), ("left", pa.int32()), ("bytes", pa.binary())])


def _suffix_batch(rows) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_SUFFIX)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SUFFIX)], schema=_SUFFIX)


class DiskQueue:
    """Blocks of tuples by priority; beyond ``memory`` bytes the least urgent ones wait in files."""

    def __init__(self, folder: str, memory: int):
        self.folder, self.memory, self.held, self.pushed = folder, memory, 0, 0
        self.heap: list = []

    def push(self, priority: tuple, block: dict[str, np.ndarray]) -> None:
        size = sum(a.nbytes for a in block.values())
        self.pushed += 1
        if self.held + size > self.memory:
            path = os.path.join(self.folder, f"{self.pushed}.npz")
            np.savez(path, **block)
            heapq.heappush(self.heap, (priority, self.pushed, 0, path))
        else:
            self.held += size
            heapq.heappush(self.heap, (priority, self.pushed, size, block))

    def pop(self) -> tuple[tuple, dict[str, np.ndarray]]:
        priority, _, size, block = heapq.heappop(self.heap)
        if isinstance(block, str):
            with np.load(block) as stored:
                loaded = dict(stored)
            os.remove(block)
            return priority, loaded
        self.held -= size
        return priority, block

    def next_priority(self):
        return self.heap[0][0] if self.heap else None


def sorted_suffixes(rows: dict, length: int, widest: int) -> dict[str, np.ndarray]:
    """Level 0: the suffixes at the anchors in order, with common prefixes.

    ``group`` must not decrease. The result holds per suffix its class, the
    prefix it shares with the one before it in its class, its document and
    position, the range of levels at which one of its windows starts, and the
    bytes left of it, nearest first.
    """
    sizes = np.array([len(b) for b in rows["bytes"]], np.int64)
    begins = np.cumsum(sizes) - sizes
    buffer = np.frombuffer(b"".join(rows["bytes"]) + bytes(length + widest), np.uint8)
    left = rows["left"].astype(np.int64)
    anchor = begins + left
    words = -(-length // 8)
    right_size = np.minimum(sizes - left, length)
    step = np.arange(words * 8)
    right = buffer[np.minimum(anchor[:, None] + step, len(buffer) - 1)]
    right[step >= right_size[:, None]] = 0
    names = right.reshape(len(sizes), words, 8).view(">u8").reshape(len(sizes), words)
    order = np.lexsort([right_size] + [names[:, j] for j in range(words - 1, -1, -1)] + [rows["group"]])
    right, right_size, group = right[order], right_size[order], rows["group"][order]
    differ = right[1:] != right[:-1]
    shared = np.where(differ.any(1), differ.argmax(1), words * 8)
    shared = np.minimum(shared, np.minimum(right_size[1:], right_size[:-1]))
    fresh = np.concatenate([[True], group[1:] != group[:-1]])
    back = anchor[order][:, None] - 1 - np.arange(widest)
    return {"class": np.cumsum(fresh), "shared": np.where(fresh, 0, np.concatenate([[0], shared])).astype(np.int32),
            "doc": rows["doc_id"][order], "place": (rows["start"] + rows["left"])[order],
            "least": (rows["left"] - rows["windows"] + 1)[order].astype(np.int16),
            "most": rows["left"][order].astype(np.int16), "left": buffer[np.maximum(back, 0)]}


def repeats_at(block: dict[str, np.ndarray], level: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and starts of the windows at this level that also start earlier."""
    here = np.flatnonzero((block["least"] <= level) & (level <= block["most"]))
    chain = np.cumsum(block["shared"] < length)[here]
    doc, start = block["doc"][here], block["place"][here] - level
    order = np.lexsort((start, doc, chain))
    chain, doc, start = chain[order], doc[order], start[order]
    if not len(chain):
        return doc, start
    first = np.concatenate([[True], chain[1:] != chain[:-1]])
    head = np.flatnonzero(first)[np.cumsum(first) - 1]
    later = (doc != doc[head]) | (start != start[head])
    return doc[later], start[later]


def induced(block: dict[str, np.ndarray], level: int) -> dict[str, np.ndarray] | None:
    """The suffixes one byte further left, in order; those alone in their class are left out."""
    kept = np.flatnonzero(block["most"] > level)
    if len(kept) < 2:
        return None
    shared = block["shared"]
    # Between two kept suffixes the smallest common prefix in between counts.
    shared = np.minimum.reduceat(shared[:kept[-1] + 1], np.concatenate([[0], kept[:-1] + 1]))
    byte = block["left"][kept, level]
    old = block["class"][kept]
    order = np.lexsort((byte, old))
    byte, old = byte[order], old[order]
    fresh = np.concatenate([[True], (old[1:] != old[:-1]) | (byte[1:] != byte[:-1])])
    ranges = np.stack([np.minimum(order[:-1], order[1:]) + 1, np.maximum(order[:-1], order[1:]) + 1], 1)
    between = np.minimum.reduceat(np.append(shared, 0), ranges.ravel())[::2]
    shared = np.where(fresh, 0, np.concatenate([[0], between + 1]))
    number = np.cumsum(fresh)
    crowd = np.bincount(number)[number] > 1
    if not crowd.any():
        return None
    rows = kept[order][crowd]
    return {k: v[rows] for k, v in block.items() if k not in ("class", "shared")} | {
        "class": number[crowd], "shared": shared[crowd].astype(np.int32)}


def _joined_blocks(blocks: list[dict]) -> dict[str, np.ndarray]:
    if len(blocks) == 1:
        return blocks[0]
    raised, out = 0, []
    for b in blocks:
        out.append(b | {"class": b["class"] + raised})
        raised += int(b["class"][-1]) + 1
    return {k: np.concatenate([b[k] for b in out]) for k in out[0]}


def sort_shard(blocks: Iterator[dict], length: int, widest: int, memory: int = MEMORY, size: int = BLOCK):
    """Run the induction over blocks of whole groups; yields documents and starts of repeated windows.

    A block of ``doc`` and ``start`` alone holds repeats that are known already.
    """
    with tempfile.TemporaryDirectory() as folder:
        queue = DiskQueue(folder, memory)
        for n, rows in enumerate(blocks):
            if "bytes" in rows:
                queue.push((0, n), sorted_suffixes(rows, length, widest))
            else:
                yield rows["doc"], rows["start"]
        while queue.heap:
            (level, n), block = queue.pop()
            some, rows = [block], len(block["class"])
            # Shrunken blocks of one level are handled together.
            while rows < size and (queue.next_priority() or (-1,))[0] == level:
                some.append(queue.pop()[1])
                rows += len(some[-1]["class"])
            block = _joined_blocks(some)
            yield repeats_at(block, level, length)
            further = induced(block, level)
            if further is not None:
                queue.push((level + 1, n), further)


def _sort_shards(suffixes: DataFrame, length: int, gram: int) -> DataFrame:
    def blocks(batches):
        held, rows = [], 0

        def ready(table):
            group = np.concatenate([[0], np.cumsum(
                (np.diff(table.column("h").to_numpy()) != 0) | (np.diff(table.column("part").to_numpy()) != 0))])
            return {"group": group, "bytes": table.column("bytes").to_pylist()} | {
                c: table.column(c).to_numpy().astype(np.int64) for c in ("doc_id", "start", "windows", "left")}
        for batch in batches:
            windows = batch.column("windows").to_numpy()
            if (windows < 0).any():
                n, doc, start = (batch.column(c).to_numpy()[windows < 0] for c in ("windows", "doc_id", "start"))
                n = -n.astype(np.int64)
                yield {"doc": np.repeat(doc, n), "start": np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - start, n)}
                batch = batch.filter(pa.array(windows > 0))
            held.append(batch)
            rows += batch.num_rows
            if rows < BLOCK:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            h, part = table.column("h").to_numpy(), table.column("part").to_numpy()
            cut = np.flatnonzero((h[1:] != h[:-1]) | (part[1:] != part[:-1]))  # the last group may go on
            if len(cut):
                yield ready(table.slice(0, int(cut[-1]) + 1))
                table = table.slice(int(cut[-1]) + 1)
            held, rows = table.to_batches(), 0 if len(cut) else table.num_rows
        if held and sum(b.num_rows for b in held):
            yield ready(pa.Table.from_batches(held).combine_chunks())

    def run(batches):
        for doc, start in sort_shard(blocks(batches), length, length - gram):
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc), pa.array(start), pa.array(start + length)], ["doc_id", "at", "stop"])
    return suffixes.repartition("h", "part").sortWithinPartitions("h", "part").mapInArrow(run, SPANS)


def repeated_spans(docs: DataFrame, run: RunFolder, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, at, stop``: byte ranges whose union is what repeats earlier text.

    Ranges of a document may overlap. Texts are UTF-8 bytes, matches stay within
    a document, and whole texts are read. A null text is empty. Rows that repeat
    an id count as the same document, so they are no repeats of each other; rows
    with a null id are left out.
    """
    docs = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = run.write(_classify(_keys(docs, length, gram), length), "runs")
    differing = found.filter(F.col("stop").isNull()).select("h", "doc_id", "at")
    sorted_ = _sort_shards(_suffixes(docs, differing, length), length, gram)
    return found.filter(F.col("stop").isNotNull()).select("doc_id", "at", "stop").union(sorted_)


def remove_repeats(docs: DataFrame, run: RunFolder, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, text bytes without repeats, n_bytes, n_removed, n_spans, spans`` of every row.

    ``kept`` holds the remaining bytes; a cut may fall inside a character, so it
    is binary. See ``repeated_spans`` for what is removed; nothing is removed
    from a row with a null id. Other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("kept", pa.binary()), ("n_bytes", pa.int64()),
                        ("n_removed", pa.int64()), ("n_spans", pa.int64())])

    def cut(batches):
        for part in chunks(batches, CHUNK):
            rows = []
            for doc_id, text, ranges in zip(*(part.column(c) for c in ("doc_id", "text", "ranges"))):
                text = text.as_py().encode()
                lo, hi = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if ranges.is_valid:
                    lo, hi = (ranges.values.field(c).to_numpy() for c in ("at", "stop"))
                lo, hi = merged(lo, np.minimum(hi, len(text)))
                edges = [0, *np.stack([lo, hi], 1).ravel().tolist(), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append({"doc_id": doc_id.as_py(), "kept": kept, "n_bytes": len(text),
                             "n_removed": int((hi - lo).sum()), "n_spans": len(lo)})
            yield pa.RecordBatch.from_pylist(rows, schema)
    ranges = (
        repeated_spans(docs, run, length, gram)
        .groupBy("doc_id").agg(F.collect_list(F.struct("at", "stop")).alias("ranges")))
    return (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(ranges, "doc_id", "left")
        .mapInArrow(cut, "doc_id bigint, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint")
    )


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the bytes that repeat 100 or more earlier ones."""
    return remove_repeats(documents(spark, folder), RunFolder(spark)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
