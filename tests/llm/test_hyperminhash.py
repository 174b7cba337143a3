import random
import re

import numpy as np
import pytest

from admesh.llm import hyperminhash as hm
from admesh.llm.tables import table as scan

DOC = "doc_id bigint, text string"


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def brute(rows):
    """Components by comparing every pair."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and sets[a]:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in ids)


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect())


def copies(seed, groups=8, size=25):
    """Groups of edited copies, chains of drifting copies, short texts and a passage that many share."""
    r = random.Random(seed)

    def word():
        return "".join(r.choice("abcdeé") for _ in range(r.randrange(1, 6)))
    passage = [word() for _ in range(12)]
    rows = []
    for g in range(groups):
        base = [word() for _ in range(r.choice([3, 8, 30, 120, 400]))]
        for _ in range(size):
            text = list(base)
            for _ in range(r.randrange(4)):
                text[r.randrange(len(text))] = word()
            if g % 2:
                base = text  # drift
            if r.random() < 0.2:
                text += passage
            rows.append(" ".join(w.upper() if r.random() < 0.1 else w for w in text))
    rows += [" ".join([word() for _ in range(4)] + passage) for _ in range(40)]
    rows += ["", None, "  \t\n", "one", "ONE", "one two", "one two three four"]
    r.shuffle(rows)
    return list(enumerate(rows, 3))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(table, run, seed):
    rows = copies(seed)
    assert got(hm.near_duplicates(table(rows, DOC).repartition(5), run)) == brute(rows)


def test_a_table_of_documents_matches_brute_force(spark, run):
    docs = scan(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(hm.op6_hyperminhash(spark, "/root/testdata/sf0.001")) == brute(rows)


def test_the_estimate_is_close(spark):
    r = np.random.default_rng(1)
    for near in (0.0, 0.5, 0.75, 0.95):
        n = 4000
        both = r.integers(0, 2**63, int(n * near), dtype=np.uint64) * np.uint64(2)
        one, two = (np.unique(np.concatenate([both, r.integers(0, 2**63, (n - len(both)) // 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]))
                    for _ in range(2))
        a, b = hm.registers([one, two], 1024)
        assert abs(hm.similarity(a[None], b[None], np.array([len(one)]))[0] - near) < 0.06


def test_equal_bands_survive_any_partitioning(table, run):
    rows = copies(5, groups=3)
    assert got(hm.near_duplicates(table(rows, DOC).coalesce(1), run)) == got(
        hm.near_duplicates(table(rows[::-1], DOC).repartition(7), run))


def test_nulls_repeats_extra_columns_and_empty_tables(table, run):
    text = "a b c d e f g h i j k l m n o p"
    rows = [(None, text), (None, None), (7, text), (7, text), (8, text.upper()), (9, text + " q"), (10, None)]
    want = [(7, 12, 7, True), (7, 12, 7, True), (8, 12, 7, False), (9, 13, 7, False), (10, 0, 10, True)]
    plain = hm.near_duplicates(table(rows, DOC), run).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in plain if r.doc_id is not None) == want
    assert [(r.component_id, r.kept) for r in plain if r.doc_id is None] == [(None, True)] * 2
    extra = table([r + (1, 2, "x") for r in rows], DOC + ", a int, k1 int, registers string")
    assert sorted(map(str, hm.near_duplicates(extra, run).collect())) == sorted(map(str, plain))
    kept = hm.keep_one(extra, run)
    assert kept.columns == extra.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["10", "7", "7", "None", "None"]
    assert hm.near_duplicates(table([], DOC), run).collect() == []


def test_a_very_long_text(table, run):
    long = " ".join(str(i) for i in range(200_000))
    rows = [(1, long), (2, long + " end"), (3, "x" * 1_000_000)]
    assert got(hm.near_duplicates(table(rows, DOC), run)) == [
        (1, 199_996, 1, True), (2, 199_997, 1, False), (3, 1, 3, True)]


def test_alike_but_unlinked_texts_do_not_meet_in_pairs(table, run, monkeypatch):
    """Thousands of texts alike at 0.6 to 0.74, some of which are linked."""
    r = random.Random(7)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(3_000):
        text = list(base)
        for at in r.sample(range(5, 195), 4 if i % 100 else 1):
            text[at] = f"own{i}_{at}"
        rows.append((i, " ".join(text)))
    sizes, write = {}, run.write

    def seen(df, name):
        out = write(df, name)
        sizes.setdefault(name, []).append(out.count())
        return out
    monkeypatch.setattr(run, "write", seen)
    got = {x.doc_id: x.component_id for x in hm.near_duplicates(table(rows, DOC), run).collect()}
    sets = {i: shingle_set(t) for i, t in rows}
    near = {i: min((j for j in sets if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])), default=i) for i in range(0, 3_000, 100)}
    assert all(got[i] == got[j] for i, j in near.items())
    assert max(sizes["pairs"]) < 10 * len(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rare_shingles_lose_no_link(table, run, seed):
    rows = copies(seed, groups=8, size=15)
    sets = {i: shingle_set(t) for i, t in rows}
    linked = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[a] != sets[b]
              and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    members = table([(i, i) for i, t in rows if sets[i]], "doc_id bigint, component bigint")
    met = {(x.a, x.b) for x in hm._rare_pairs(members, table(rows, DOC), run, 75).collect()}
    assert linked <= met and linked and len(met) < len(sets) ** 2 / 2
