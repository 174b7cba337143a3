import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from admesh.llm import decontaminate as dc
from admesh.llm.tables import table as scan

DOC, ITEM = "doc_id bigint, text string", "item_id bigint, text string"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(w):
    return [" ".join(w[i:i + 3]) for i in range(len(w) - 2)]


def fingerprint(w):
    votes = [0] * 64
    for i in range(len(w) - 2):
        h = 42
        for x in w[i:i + 3]:
            h = xxhash.xxh64_intdigest(x.encode(), h)
        weight = len(" ".join(w[i:i + 3]))
        for b in range(64):
            votes[b] += weight if h >> b & 1 else -weight
    return sum(1 << b for b in range(64) if votes[b] > 0)


def likeness(a, b):
    a, b = Counter(shingles(a)), Counter(shingles(b))
    return sum(len(s) * n for s, n in (a & b).items()) / sum(len(s) * n for s, n in (a | b).items())


def brute(docs, items):
    """Every window of an item's size against every item, whatever the fingerprints."""
    out = {}
    sizes = sorted({len(words(t)) for _, t in items if len(words(t)) >= 3})
    marks = [(i, words(t)) for i, t in items if len(words(t)) >= 3]
    known = {s for _, w in marks for s in shingles(w)}
    for doc, text in docs:
        w = words(text)
        hits = [i for i, s in enumerate(shingles(w)) if s in known]  # a window without one is unlike all items
        for size in sizes:
            last = max(len(w) - size, 0)
            for start in sorted({s for i in hits for s in range(max(i - size + 3, 0), min(i, last) + 1)}):
                own = w[start:start + size]
                if len(own) < 3:
                    continue
                for item, other in marks:
                    if len(other) == size and likeness(own, other) >= dc.SIMILARITY:
                        key = (round(likeness(own, other), 6), -start, len(own))
                        out[doc, item] = max(out.get((doc, item), (0, 0, 0)), key)
    return {k: v[0] for k, v in out.items()}


def corpus(seed):
    r = random.Random(seed)

    def prose(n):
        return [r.choice("river stone under light paper green walk table quiet Éte 12 b".split()) + r.choice("abcdefgh") for _ in range(n)]
    items = [(i, " ".join(prose(r.randrange(3, 30)))) for i in range(12)] + [(90, "two words"), (91, ""), (92, None)]
    docs = []
    for d in range(60):
        text = prose(r.randrange(40))
        if d % 2:
            passage = r.choice(items[:12])[1].split()
            if r.random() < 0.5 and len(passage) > 9:
                passage[r.randrange(len(passage))] = "changed"
            if r.random() < 0.3:
                passage = [p.upper() + r.choice(["!!", ",", ""]) for p in passage]
            text[len(text) // 2:len(text) // 2] = passage
        docs.append((d, " ".join(text)))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_agree_with_brute_force(table, run, seed):
    docs, items = corpus(seed)
    got = {(r.doc_id, r.item_id): r.similarity for r in dc.matches(table(docs, DOC), table(items, ITEM), run).collect()}
    want = brute(docs, items)
    # A window that shares a shingle is laid where the shingle puts it, which is where the best one lies.
    assert got.keys() == want.keys() and len(want) > 15
    assert sum(got[k] == pytest.approx(want[k]) for k in want) >= 0.9 * len(want)


def test_edited_passages_are_found_whatever_their_fingerprints(table, run):
    r = random.Random(3)
    vocabulary = ["".join(r.choices("abcdefghij", k=r.randrange(2, 9))) for _ in range(2_000)]
    items, docs = [], []
    for i in range(120):
        passage = r.choices(vocabulary, k=r.randrange(24, 60))
        edited = list(passage)
        for _ in range(1 + (len(passage) > 45)):
            edited[r.randrange(len(edited))] = "changed"
        items.append((i, " ".join(passage)))
        docs.append((i, " ".join(r.choices(vocabulary, k=20) + edited + r.choices(vocabulary, k=20))))
    own, other = [[words(t) for _, t in side] for side in (docs, items)]
    want = {}
    for i, (w, x) in enumerate(zip(own, other)):
        best = max(likeness(w[start:start + len(x)], x) for start in range(len(w) - len(x) + 1))
        if best >= dc.SIMILARITY:
            want[i, i] = pytest.approx(best, abs=1e-6)
    got = {(g.doc_id, g.item_id): g.similarity for g in dc.matches(table(docs, DOC), table(items, ITEM), run).collect()}
    assert got == want and len(want) > 60


def test_fingerprints_and_words_are_the_stated_ones(table):
    text = "The ÉTÉ, of\n12 x_y; the été of 12"
    row = table([(text,)], "t string").select(dc.words_of(F.col("t")).alias("w")).select(
        "w", dc.simhash(dc._shingles(F.col("w"))).alias("f")).first()
    assert row.w == words(text) and row.f % 2**64 == fingerprint(words(text))


def test_the_masks_reach_every_fingerprint_within_the_radius():
    r, masks = random.Random(1), set(dc._near_masks())
    for _ in range(500):
        flips = sum(1 << b for b in r.sample(range(64), dc.RADIUS))
        assert any(flips >> dc.BITS * i & (1 << dc.BITS) - 1 in masks for i in range(dc.BLOCKS))


def test_planted_passages_are_found_and_nothing_else(spark, run):
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, words(r.text)) for r in scan(spark, folder, "documents").collect()]
    items = [(r.item_id, words(r.text)) for r in scan(spark, folder, "benchmark").collect()]
    planted = {(d, i) for d, w in docs for i, x in items if f" {' '.join(x)} " in f" {' '.join(w)} "}
    got = {(r.doc_id, r.item_id): r for r in dc.op1_decontaminate(spark, folder).collect()}
    assert planted <= got.keys() and planted
    own, other = dict(docs), dict(items)
    assert all(likeness(own[d][r.start:r.start + r.n_words], other[i]) >= dc.SIMILARITY for (d, i), r in got.items())


def test_the_plan_stays_native(spark):
    text = dc.op1_decontaminate(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", text)


def test_nulls_repeats_extra_columns_and_empty_tables(table, run):
    passage = "one two three four five six seven eight nine ten"
    docs = [(None, passage), (1, passage), (1, passage), (2, None), (3, ""), (4, "x " * 30_000 + passage)]
    items = [(None, passage), (7, passage), (7, passage), (8, None), (9, "one two")]
    got = dc.matches(table(docs, DOC), table(items, ITEM), run)
    assert sorted((r.doc_id, r.item_id, r.similarity, r.start) for r in got.collect()) == [
        (1, 7, 1.0, 0), (4, 7, 1.0, 30_000)]
    wide = table([r + (1, "w") for r in docs], DOC + ", words int, item_id string")
    assert sorted(map(str, dc.matches(wide, table(items, ITEM), run).collect())) == sorted(map(str, got.collect()))
    assert sorted(str(r.doc_id) for r in dc.keep_clean(wide, table(items, ITEM), run).collect()) == ["2", "3", "None"]
    assert dc.matches(table([], DOC), table(items, ITEM), run).collect() == []
    assert dc.keep_clean(wide, table([], ITEM), run).count() == 6


def test_windows_meet_few_items_and_fewer_of_many(spark, table, run, monkeypatch):
    """Pairs of windows and items that are compared, as a share of all pairs, with the benchmark and with ten times as many items."""
    folder, r = "/root/testdata/sf0.01", random.Random(2)
    items = [(x.item_id, x.text) for x in scan(spark, folder, "benchmark").collect()]
    vocabulary = " ".join(t for _, t in items).split()
    more = items + [(10_000 + i, " ".join(r.choices(vocabulary, k=30))) for i in range(9 * len(items))]
    sizes, write = {}, run.write

    def seen(df, name):
        out = write(df, name)
        sizes[name] = out.select("window").distinct().count() * 1.0 if name == "windows" else out.count()
        return out
    monkeypatch.setattr(run, "write", seen)
    shares = []
    for some in (items, more):
        dc.matches(scan(spark, folder, "documents"), table(some, ITEM), run).collect()
        shares.append(sizes["distinct"] / (sizes["windows"] * len(some)))
    assert shares[0] < 1.5 / len(items) and shares[1] < shares[0] / 2  # about one item for each window


def test_long_items_are_verified_in_time(table, run):
    r = random.Random(4)
    words_ = [f"w{r.randrange(3_000)}" for _ in range(8_000)]
    text = " ".join(["before"] * 50 + words_[:4_000] + [f"other{i}" for i in range(200)] + words_[4_200:] + ["after"] * 50)
    (got,) = dc.matches(table([(1, text)], DOC), table([(1, " ".join(words_))], ITEM), run).collect()
    assert got.n_words == 8_000 and got.similarity > 0.9
