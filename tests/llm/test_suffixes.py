import hashlib
import random

import numpy as np
import pytest

from admesh.llm import suffixes
from admesh.llm.tables import documents

DOC = "doc_id bigint, text string"


def brute(rows, length):
    """Mark the bytes of every string that was seen before, reading documents in order of id."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            piece = data[i:i + length]
            if piece in seen:
                gone[i:i + length] = True
            seen.add(piece)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = data if not gone.any() else np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def got(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest())
                  for r in df.collect())


def patchwork(seed, docs=120):
    """Texts of shared and fresh passages, some periodic, some copies."""
    r = random.Random(seed)

    def fresh(n):
        return "".join(r.choice("ab é\0\n") for _ in range(n))
    shared = [fresh(r.randrange(10, 90)) for _ in range(12)] + ["ab" * 40, "é" * 50, "a" * 120, "\0" * 60]
    rows = []
    for i in range(docs):
        text = "".join(r.choice(shared) if r.random() < 0.6 else fresh(r.randrange(40)) for _ in range(r.randrange(9)))
        rows.append(text if r.random() < 0.8 or not rows else r.choice(rows)[r.randrange(3):])
    rows += ["x" * 500, "", None]
    ids = r.sample(range(-1000, 1000), len(rows))
    return list(zip(ids, rows))


@pytest.mark.parametrize("seed, hot, block", [(1, 20_000, 20_000), (2, 3, 7), (3, 20_000, 5)])
def test_matches_brute_force(table, run, monkeypatch, seed, hot, block):
    monkeypatch.setattr(suffixes, "HOT", hot)
    rows = patchwork(seed)
    docs = table(rows, DOC).repartition(4)
    assert got(suffixes.remove_repeats(docs, run, 30, 8)) == brute(rows, 30)


@pytest.mark.parametrize("folded", [1, 50, 200_000])
def test_a_line_of_many_documents_is_folded_before_it_is_dealt_out(table, run, monkeypatch, folded):
    r = random.Random(folded)
    monkeypatch.setattr(suffixes, "HOT", 20)
    monkeypatch.setattr(suffixes, "FOLDED", folded)
    line = "".join(r.choice("abcdefgh") for _ in range(60))
    rows = [(i, "".join(r.choice("abc") for _ in range(r.randrange(9, 40))) + line + r.choice("xyz") * 5) for i in range(600)]
    rows += [(3, rows[3][1]), (700, rows[5][1])]
    docs = table(rows, DOC).repartition(4)
    assert got(suffixes.remove_repeats(docs.dropDuplicates(), run, 30, 8)) == brute(dict(rows).items(), 30)
    keys = run.write(suffixes._classify(suffixes._keys(docs, 30, 8), 30), "runs").filter("stop is null")
    dealt = suffixes._suffixes(docs, keys.select("h", "doc_id", "at"), 30)
    groups = {(x.h, x.part): x["count"] for x in dealt.filter("part != 0 and windows > 0").groupBy("h", "part").count().collect()}
    assert groups and (folded < 1000 or max(groups.values()) <= docs.rdd.getNumPartitions())


def test_documents_match_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in documents(spark, folder).collect()]
    result = suffixes.op3_suffix_dedup(spark, folder).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in result) == brute(rows, 100)


@pytest.mark.parametrize("memory", [0, 3000, 10**9])
def test_the_queue_on_disk_gives_the_same_repeats(memory):
    r = random.Random(memory)
    rows = []
    for group in range(30):
        base = bytes(r.choice(b"ab") for _ in range(40))
        for i in range(r.randrange(2, 8)):
            own = bytearray(base)
            own[r.randrange(40)] = r.choice(b"abc")
            left = 12
            own[left:left + 8] = bytes([group]) * 8
            rows.append((group, bytes(own), i, 1000 * group, 11, left))
    columns = dict(zip(("group", "bytes", "doc_id", "start", "windows", "left"), zip(*rows)))
    blocks = []
    for lo, hi in ((0, 9), (9, 20), (20, 30)):
        chosen = [i for i, x in enumerate(columns["group"]) if lo <= x < hi]
        blocks.append({k: [v[i] for i in chosen] if k == "bytes" else np.array([v[i] for i in chosen])
                       for k, v in columns.items()})
    found = {(d, s) for doc, start in suffixes.sort_shard(iter(blocks), 30, 22, memory, 4)
             for d, s in zip(doc.tolist(), start.tolist())}
    seen, want = {}, set()
    for group, data, doc, start, windows, left in sorted(rows, key=lambda x: x[2]):
        for w in range(windows):
            key = (group, w, data[w:w + 30])
            if key in seen:
                want.add((doc, start + w))
            seen[key] = 1
    assert found == want and want


def test_the_queue_holds_no_more_than_its_memory():
    r = np.random.default_rng(1)
    memory, widest = 20_000, 22
    held = []

    class Watched(suffixes.DiskQueue):
        def push(self, priority, block):
            super().push(priority, block)
            held.append(self.held)
    shared = r.integers(97, 99, (400, 51)).astype(np.uint8)  # windows of 400 anchors, several texts each
    blocks = []
    for lo in range(0, 400, 20):
        group = np.repeat(np.arange(lo, lo + 20), 10)
        data = [shared[g].tobytes() for g in group]
        n = len(group)
        blocks.append({"group": group, "bytes": data, "doc_id": np.tile(np.arange(10), 20), "start": 100 * group,
                       "windows": np.full(n, 22), "left": np.full(n, 21)})
    size = sum(a.nbytes for b in blocks for a in suffixes.sorted_suffixes(b, 30, widest).values())
    assert size > 10 * memory
    original, suffixes.DiskQueue = suffixes.DiskQueue, Watched
    try:
        found = sum(len(doc) for doc, _ in suffixes.sort_shard(iter(blocks), 30, widest, memory, 50))
    finally:
        suffixes.DiskQueue = original
    assert found == 400 * 9 * 22 and 0 < max(held) <= memory


def test_nulls_repeats_extra_columns_and_empty_tables(table, run):
    long = "".join(chr(97 + i * i % 26) for i in range(300))
    rows = [(None, long), (None, None), (4, long), (4, long), (5, "é" + long), (6, None)]
    plain = suffixes.remove_repeats(table(rows, DOC), run)
    assert sorted((str(r.doc_id), r.n_removed) for r in plain.collect()) == [
        ("4", brute([(4, long)], 100)[0][2])] * 2 + [("5", 300), ("6", 0), ("None", 0), ("None", 0)]
    extra = table([r + (1, 2, b"x") for r in rows], DOC + ", at int, h int, kept binary")
    assert sorted(map(str, suffixes.remove_repeats(extra, run).collect())) == sorted(map(str, plain.collect()))
    assert suffixes.remove_repeats(table([], DOC), run).collect() == []


def test_a_very_long_text(table, run):
    r = random.Random(9)
    half = "".join(r.choice("abcdefgh") for _ in range(700_000))
    (row,) = suffixes.remove_repeats(table([(1, half + "|" + half)], DOC), run).collect()
    assert (row.n_removed, row.n_spans) == (700_000, 1) and bytes(row.kept).decode() == half + "|"
