"""SentencePiece encoding to the N best segmentations, and decoding.

A text is a path through the lattice of vocabulary pieces, and a path costs the
sum of its pieces' costs. A forward Viterbi pass gives every node the cost of
its best prefix. That is an exact heuristic for an A* search that walks the
lattice backwards from the end, which therefore reaches complete paths in the
order of their cost and expands nothing that cannot lead to one of the N best.

No piece of the vocabulary crosses a line feed or continues after a space, so
the lattice falls into segments that are searched once per batch of texts. The
forward pass keeps the two best prefixes: the gap between them at a segment's
end is the least that leaving its best path costs. The N best paths of a text
deviate only in the N - 1 segments with the smallest gaps, since deviating in
one of them already gives N - 1 paths that are no dearer, so A* runs over
those segments and the others stay on their best path.

Spaces become the vocabulary's space mark with one put before the text. A
literal space mark and characters without a piece are spelled in byte pieces,
which makes decoding exact for every text. Costs are whole numbers, so ties are
real and are settled by the longer last piece.
"""

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from admesh.llm.tables import documents

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
CHUNK = 4_000_000  # code points that share one pass over their distinct segments
ROWS = 20_000  # segments of one length that go through the forward pass together
LONG = 64  # longer segments take the scalar forward pass

_SPACE = "▁"
_SEGMENT = re.compile(r" +[^ \n]*|[^ \n]+|\n")
_NONE = 1 << 29
_BASE = np.uint64(0x9E3779B97F4A7C15)

ENCODED = ("doc_id bigint, ids array<int>, cost bigint, "
           "alternatives array<struct<cost:bigint,edits:array<struct<start:int,count:int,ids:array<int>>>>>")


class Vocabulary:
    """Pieces of a model with their costs: 1000 times the logarithm of a piece's merge rank."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes: list[bytes] = []
        self.byte_ids = [0] * 256
        self.pieces: dict[str, tuple[int, int]] = {}  # spelled with spaces
        size = model.get_piece_size()
        self.byte_cost = round(1000 * np.log(2 + size))
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes.append(b"")
            else:
                piece = piece.replace(_SPACE, " ")
                self.pieces[piece] = (i, round(1000 * float(np.log(2 - model.get_score(i)))))
                self.bytes.append(piece.encode())
        self.longest = max(map(len, self.pieces))
        if any(" " in p.lstrip(" ") or "\n" in p or p.startswith("  ") and p.strip(" ") for p in self.pieces):
            raise ValueError("a piece crosses the segments' bounds")
        self._build_table()

    def _build_table(self):
        """Two hash tables from a piece's rolling hash; the second takes the first one's collisions."""
        hashes = np.array([self._hash(p) for p in self.pieces], np.uint64)
        ids, costs = (np.array(x, np.int32) for x in zip(*self.pieces.values()))
        self.tables, rest = [], np.arange(len(hashes))
        for bits in (20, 18, 16):
            slots = (hashes[rest] * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)
            _, first = np.unique(slots, return_index=True)
            keys = np.zeros(1 << bits, np.uint64)
            values = np.full((2, 1 << bits), _NONE, np.int32)
            took = rest[first]
            keys[slots[first]], values[0, slots[first]], values[1, slots[first]] = hashes[took], ids[took], costs[took]
            self.tables.append((np.uint64(64 - bits), keys, values))
            rest = np.setdiff1d(rest, took)
            if not len(rest):
                return
        raise ValueError("the piece table is too full")

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c) + 1) % (1 << 64)
        return h

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and costs of the pieces with these hashes; costs are ``_NONE`` where there is none."""
        mixed = hashes * np.uint64(0xD6E8FEB86659FD93)
        ids = np.full(hashes.shape, -1, np.int32)
        costs = np.full(hashes.shape, _NONE, np.int32)
        for shift, keys, values in self.tables:
            slots = (mixed >> shift).astype(np.int64)
            hit = keys[slots] == hashes
            ids = np.where(hit, values[0][slots], ids)
            costs = np.where(hit, values[1][slots], costs)
        return ids, costs

    def spell(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()]


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def lattice(vocab: Vocabulary, segment: str):
    """``arcs[end]``: (length, cost, ids) of the pieces that end there, longest first."""
    arcs = [[] for _ in range(len(segment) + 1)]
    for end in range(1, len(segment) + 1):
        for length in range(min(vocab.longest, end), 0, -1):
            found = vocab.pieces.get(segment[end - length:end])
            if found:
                arcs[end].append((length, found[1], [found[0]]))
        if not arcs[end] or arcs[end][-1][0] != 1:
            ids = vocab.spell(segment[end - 1])
            arcs[end].append((1, len(ids) * vocab.byte_cost, ids))
    return arcs


def forward(arcs):
    """Cost of the best and second best path to every node, and the best one's last arc."""
    best, second, last = [0], [_NONE << 20], [None]
    for end in range(1, len(arcs)):
        b, s, a = _NONE << 20, _NONE << 20, None
        for arc in arcs[end]:
            at = end - arc[0]
            one, two = best[at] + arc[1], second[at] + arc[1]
            s = min(max(b, one), s, two)
            if one < b:
                b, a = one, arc
        best.append(b)
        second.append(s)
        last.append(a)
    return best, second, last


def backward_search(segments, n: int):
    """The n best paths over consecutive segments' ``(arcs, best)``, cheapest first.

    Returns costs and chains ``(length, (length, ... None))`` of the arcs' lengths in
    reading order. The heap orders partial paths by their cost so far plus the
    exact cost of the best rest.
    """
    before, sizes = [0], [0]
    for _, best in segments:
        before.append(before[-1] + best[-1])
        sizes.append(sizes[-1] + len(best) - 1)
    top, pushed = len(segments) - 1, 0
    # Among equals the path with the shorter rest, then the one found first. A path
    # is a chain of (length, path so far), so extending one copies nothing.
    heap = [(before[-1], sizes[-1], 0, None, top, 0)] if segments else []
    found = []
    while heap and len(found) < n:
        total, rest, _, path, k, cost = heapq.heappop(heap)
        if rest == 0:
            found.append((total, path))
            continue
        while rest == sizes[k]:
            k -= 1
        at = rest - sizes[k]
        arcs, best = segments[k]
        for length, price, _ in arcs[at]:
            pushed += 1
            heapq.heappush(heap, (cost + price + best[at - length] + before[k], rest - length, pushed,
                                  (length, path), k, cost + price))
    return found


class Encoder:
    """Encodes batches of texts; see the module for the method."""

    def __init__(self, path: str = MODEL, n: int = N_BEST):
        self.vocab = vocabulary(path)
        self.n = n
        self._searchable = lru_cache(maxsize=2_000)(self._arcs_and_costs)
        self._search = lru_cache(maxsize=2_000)(self._paths)

    def _arcs_and_costs(self, segment: str):
        arcs = lattice(self.vocab, segment)
        return arcs, forward(arcs)[0]

    def _paths(self, segments: tuple[str, ...]):
        return backward_search([self._searchable(s) for s in segments], self.n)

    def _best_of_length(self, segments: list[str], length: int):
        """Best path's ids, its cost, and the gap to the second best, for segments of one length."""
        vocab = self.vocab
        n = len(segments)
        codes = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32).reshape(n, length)
        codes = codes.astype(np.uint64) + np.uint64(1)
        widest = min(vocab.longest, length)
        ids = np.full((widest + 1, n, length), -1, np.int32)
        costs = np.full((widest + 1, n, length), _NONE, np.int32)
        hashes = np.zeros((n, length), np.uint64)
        for m in range(1, widest + 1):
            hashes = hashes[:, :length - m + 1] * _BASE + codes[:, m - 1:]
            ids[m, :, :length - m + 1], costs[m, :, :length - m + 1] = vocab.find(hashes)
        unknown = ids[1] < 0
        if unknown.any():
            spelled = np.array([len(chr(c - 1).encode()) for c in codes[unknown].tolist()], np.int32)
            costs[1][unknown] = spelled * vocab.byte_cost
        best = np.full((n, length + 1), _NONE, np.int32)
        second = np.full((n, length + 1), _NONE, np.int32)
        last = np.zeros((n, length + 1), np.int8)
        best[:, 0] = 0
        for end in range(1, length + 1):
            b, s, a = best[:, end], second[:, end], last[:, end]
            for m in range(min(widest, end), 0, -1):
                price = costs[m, :, end - m]
                one, two = np.minimum(best[:, end - m] + price, _NONE), np.minimum(second[:, end - m] + price, _NONE)
                np.minimum(np.minimum(s, two), np.maximum(b, one), out=s)
                a[one < b] = m
                np.minimum(b, one, out=b)
        rows, at = np.arange(n), np.full(n, length)
        reverse = []
        while at.any():
            m = last[rows, at].astype(np.int64)
            start = at - m
            reverse.append(np.where(at > 0, ids[m, rows, np.maximum(start, 0)], -2))
            at = np.maximum(start, 0)
        path = np.stack(reverse[::-1], 1)
        kept = path != -2
        flat, counts = path[kept], kept.sum(1)
        if (flat == -1).any():
            flat, counts = self._spelled(segments, unknown, flat, counts)
        gap = np.where(second[:, length] >= _NONE, np.int64(_NONE), second[:, length].astype(np.int64) - best[:, length])
        return flat, counts, best[:, length].astype(np.int64), gap

    def _spelled(self, segments, unknown, flat, counts):
        """Replace the marker of a character without a piece by its byte pieces."""
        parts, sizes, at = [], [], 0
        for segment, strange, count in zip(segments, unknown, counts.tolist()):
            chars = iter([c for c, u in zip(segment, strange.tolist()) if u])
            own = []
            for i in flat[at:at + count].tolist():
                own += self.vocab.spell(next(chars)) if i < 0 else [i]
            parts += own
            sizes.append(len(own))
            at += count
        return np.array(parts, np.int32), np.array(sizes)

    def _best_scalar(self, segment: str):
        best, second, last = forward(lattice(self.vocab, segment))
        ids, at = [], len(segment)
        while at:
            ids.append(last[at][2])
            at -= last[at][0]
        flat = [i for piece in reversed(ids) for i in piece]
        return flat, best[-1], min(second[-1] - best[-1], _NONE)

    def _best_paths(self, segments: list[str]):
        """Flat ids with starts and counts, costs and gaps of the distinct segments."""
        n = len(segments)
        lengths = np.array([len(s) for s in segments], np.int64)
        starts, counts = np.zeros(n, np.int64), np.zeros(n, np.int64)
        costs, gaps = np.zeros(n, np.int64), np.zeros(n, np.int64)
        parts, used = [], 0
        order = np.argsort(lengths, kind="stable")
        bounds = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            for at in range(lo, hi, ROWS):
                rows = order[at:min(hi, at + ROWS)]
                own = [segments[i] for i in rows.tolist()]
                if lengths[rows[0]] > LONG:
                    done = [self._best_scalar(s) for s in own]
                    flat = np.array([i for d in done for i in d[0]], np.int32)
                    size = np.array([len(d[0]) for d in done])
                    cost, gap = np.array([d[1] for d in done]), np.array([d[2] for d in done])
                else:
                    flat, size, cost, gap = self._best_of_length(own, int(lengths[rows[0]]))
                starts[rows] = used + np.cumsum(size) - size
                counts[rows], costs[rows], gaps[rows] = size, cost, gap
                parts.append(flat)
                used += len(flat)
        return np.concatenate(parts) if parts else np.zeros(0, np.int32), starts, counts, costs, gaps

    def encode(self, texts: list[str]):
        """``(offsets, ids, costs, alternatives)``: text i has the ids between its offsets.

        ``alternatives[i]`` lists the other of the n best segmentations as
        ``cost`` and ``edits``: ``count`` ids from ``start`` are replaced by ``ids``.
        """
        index: dict[str, int] = {}
        number, ends = [], []
        for text in texts:
            number += [index.setdefault(s, len(index)) for s in _SEGMENT.findall(" " + text)]
            ends.append(len(number))
        segments, used = list(index), np.array(number, np.int64)
        flat, starts, counts, costs, gaps = self._best_paths(segments)
        sizes = counts[used]
        before = np.cumsum(sizes) - sizes
        ids = flat[np.repeat(starts[used] - before, sizes) + np.arange(int(sizes.sum()))]
        offsets, totals, alternatives, lo = [0], [], [], 0
        for hi in ends:
            own = used[lo:hi]
            totals.append(int(costs[own].sum()))
            alternatives.append(self._alternatives(segments, own, gaps[own], sizes[lo:hi], totals[-1]))
            offsets.append(int(before[hi - 1] + sizes[hi - 1]))
            lo = hi
        return np.array(offsets, np.int32), ids, totals, alternatives

    def _alternatives(self, segments, own, gaps, sizes, total):
        if self.n < 2:
            return []
        open_ = np.flatnonzero(gaps < _NONE)
        if len(open_) > self.n - 1:
            limit = np.partition(gaps[open_], self.n - 2)[self.n - 2]
            below, equal = open_[gaps[open_] < limit], open_[gaps[open_] == limit]
            open_ = np.sort(np.concatenate([below, equal[:self.n - 1 - len(below)]]))
        if not len(open_):
            return []
        names = tuple(segments[own[i]] for i in open_.tolist())
        found = self._search(names)
        first = np.cumsum(sizes) - sizes
        out = []
        best = _by_segment(found[0][1], names)
        for cost, path in found[1:]:
            edits = []
            for k, (cuts, usual) in enumerate(zip(_by_segment(path, names), best)):
                if cuts != usual:
                    arcs = self._searchable(names[k])[0]
                    ids, at = [], 0
                    for length in cuts:
                        at += length
                        ids += next(a[2] for a in arcs[at] if a[0] == length)
                    i = open_[k]
                    edits.append({"start": int(first[i]), "count": int(sizes[i]), "ids": ids})
            out.append({"cost": total + cost - found[0][0], "edits": edits})
        return out


def _by_segment(path, names: tuple[str, ...]) -> list[list[int]]:
    """Piece lengths of each segment of a path."""
    out = []
    for name in names:
        rest, own = len(name), []
        while rest:
            length, path = path
            own.append(length)
            rest -= length
        out.append(own)
    return out


def decode(vocab: Vocabulary, ids) -> str:
    """The text of a sequence of ids, without the space put before it."""
    return b"".join([vocab.bytes[i] for i in ids]).decode()[1:]


def edited(ids: list[int], edits) -> list[int]:
    """An alternative segmentation's ids."""
    for e in sorted(edits, key=lambda e: -e["start"]):
        ids = ids[:e["start"]] + list(e["ids"]) + ids[e["start"] + e["count"]:]
    return ids


def _chunks(batches, size):
    """Slices of the batches that hold about ``size`` code points, one text at least."""
    for batch in batches:
        lengths = np.array([len(t or "") for t in batch.column("text").to_pylist()], np.int64)
        ends = np.cumsum(lengths)
        at = 0
        while at < len(lengths):
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + size, "right")))
            yield batch.slice(at, stop - at)
            at = stop


_EDIT = pa.struct([("start", pa.int32()), ("count", pa.int32()), ("ids", pa.list_(pa.int32()))])
_ALTERNATIVES = pa.list_(pa.struct([("cost", pa.int64()), ("edits", pa.list_(_EDIT))]))


def encode_documents(docs: DataFrame, model: str = MODEL, n: int = N_BEST, verify: bool = False) -> DataFrame:
    """Encode ``doc_id, text``: the best ``ids`` with their ``cost``, and the other n - 1 best as edits of them.

    One row per input row, whole texts, null texts read as empty; other columns
    are ignored. An empty text is the lone space mark. A text has fewer
    alternatives only if it has fewer segmentations. Runs without a shuffle.

    With ``verify`` the ids are decoded at once: ``text_sha256`` is the digest of
    the decoded text, and a text that does not come back is an error.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        encoder = Encoder(model, n)
        for part in _chunks(batches, CHUNK):
            texts = [t or "" for t in part.column("text").to_pylist()]
            offsets, ids, costs, alternatives = encoder.encode(texts)
            columns = [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
                       pa.array(costs, pa.int64()), pa.array(alternatives, _ALTERNATIVES)]
            if verify:
                columns.append(pa.array(_verified(encoder.vocab, texts, offsets, ids), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "cost", "alternatives", "text_sha256"][:len(columns)])

    return docs.select("doc_id", "text").mapInArrow(run, ENCODED + ", text_sha256 string" * verify)


def _verified(vocab: Vocabulary, texts: list[str], offsets: np.ndarray, ids: np.ndarray) -> list[str]:
    """Digests of the decoded texts."""
    out = []
    for text, lo, hi in zip(texts, offsets.tolist(), offsets[1:].tolist()):
        decoded = decode(vocab, ids[lo:hi].tolist())
        if decoded != text:
            raise ValueError(f"{hi - lo} pieces do not decode to their text of {len(text)} code points")
        out.append(hashlib.sha256(decoded.encode()).hexdigest())
    return out


def decode_documents(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """Decode ``encode_documents`` rows and digest them.

    ``text_sha256`` is of the decoded best path; ``same`` tells that every
    alternative decodes to the same text; ``costs`` lists all n best.
    """
    def run(batches):
        vocab = vocabulary(model)
        for batch in batches:
            rows = []
            for doc_id, ids, cost, alternatives in zip(*(batch.column(c) for c in ("doc_id", "ids", "cost", "alternatives"))):
                own = ids.values.to_numpy()
                listed = own.tolist()
                text = decode(vocab, listed)
                others = alternatives.as_py()
                same = True
                for other in others:
                    for e in other["edits"]:
                        cut = listed[e["start"]:e["start"] + e["count"]]
                        same &= [vocab.bytes[i] for i in cut] != [vocab.bytes[i] for i in e["ids"]] and (
                            b"".join(vocab.bytes[i] for i in cut) == b"".join(vocab.bytes[i] for i in e["ids"]))
                rows.append({"doc_id": doc_id.as_py(), "n_pieces": len(own),
                             "ids_sha256": hashlib.sha256(own.astype("<i4").tobytes()).hexdigest(),
                             "text_sha256": hashlib.sha256(text.encode()).hexdigest(), "same": bool(same),
                             "costs": ",".join(str(c) for c in [cost.as_py()] + [o["cost"] for o in others])})
            yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("ids_sha256", pa.string()),
                        ("text_sha256", pa.string()), ("same", pa.bool_()), ("costs", pa.string())])
    return encoded.mapInArrow(
        run, "doc_id bigint, n_pieces bigint, ids_sha256 string, text_sha256 string, same boolean, costs string")


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded to its N best segmentations and decoded again."""
    return decode_documents(encode_documents(documents(spark, folder)))
