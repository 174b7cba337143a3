import math
import random

import numpy as np
import pytest

from admesh.llm import likelihood as lm
from admesh.llm.tables import documents

DOC = "doc_id bigint, text string"


def grammar(r, sentences):
    subject, verb, thing = ["cat", "dog", "bird", "fox"], ["sees", "hears", "likes"], ["tree", "house", "river", "moon"]
    return " ".join(f"the {r.choice(subject)} {r.choice(verb)} a {r.choice(thing)} today" for _ in range(sentences))


def counted(texts, bits=16):
    words = np.concatenate([*lm.tokens(texts), np.zeros(0, np.uint32)])
    return np.bincount(words >> np.uint32(32 - bits), minlength=1 << bits).astype(np.int64)


def model(texts, rounds=30):
    counts = counted(texts)
    words = lm.lexicon(counts)
    weights = lm.initial(counts, words)
    before = {k: v.copy() for k, v in weights.items()}
    every = lm.in_context(lm.tokens(texts), words.packed())
    for _ in range(rounds):
        lm.descend(weights, every, lm.RATE)
    return before, weights, words


def mean_score(weights, words, text):
    return lm.token_scores(weights, lm.in_context(lm.tokens([text]), words.packed())).mean()


def plain_score(weights, words, text):
    """Log-probability of a text, one token at a time in plain Python."""
    (hashes,) = lm.tokens([text])
    slots = [int(h) >> 32 - int(math.log2(len(words.share))) for h in hashes]
    rows = [lm.ROWS] * 2 + [int(words.row[s]) for s in slots] + [lm.ROWS] * 2

    def log_softmax(x, at):
        return x[at] - max(x) - math.log(sum(math.exp(v - max(x)) for v in x))
    total = 0.0
    for i, slot in enumerate(slots):
        near = [rows[i], rows[i + 1], rows[i + 3], rows[i + 4]]
        hidden = [math.tanh(sum(float(weights["embed"][k][n][j]) for k, n in enumerate(near)) + float(weights["hidden"][j]))
                  for j in range(lm.HIDDEN)]
        c, leaf = int(words.class_[slot]), int(words.leaf[slot])
        total += log_softmax([sum(h * float(w) for h, w in zip(hidden, weights["out"][:, k])) + float(weights["bias"][k])
                              for k in range(lm.CLASSES)], c) + float(words.share[slot])
        if c >= lm.ALONE:
            total += log_softmax([sum(h * float(w) for h, w in zip(hidden, weights["deep"][c][:, k])) + float(weights["deep_bias"][c][k])
                                  for k in range(lm.LEAVES)], leaf)
    return total


def test_the_network_beats_unigrams_on_held_out_text_and_prefers_its_order():
    r = random.Random(1)
    before, weights, words = model([grammar(r, 40) for _ in range(40)])
    fresh = grammar(r, 60)
    shuffled = fresh.split()
    r.shuffle(shuffled)
    assert mean_score(weights, words, fresh) > mean_score(before, words, fresh) + 1
    assert mean_score(weights, words, fresh) > mean_score(weights, words, " ".join(shuffled)) + 1


def test_scores_match_plain_python():
    r = random.Random(2)
    texts = [grammar(r, 20) + " " + " ".join(f"rare{r.randrange(5000)}" for _ in range(300)) for _ in range(20)]
    _, weights, words = model(texts, 3)
    for text in [grammar(r, 2), "rare17 the rare4000", "", "unseen words only"]:
        got = lm.token_scores(weights, lm.in_context(lm.tokens([text]), words.packed())).sum()
        assert got == pytest.approx(plain_score(weights, words, text), rel=1e-4, abs=1e-4)


def test_swapping_two_rare_words_changes_the_score():
    r = random.Random(3)
    texts = [" ".join(f"rare{r.randrange(20_000)}" for _ in range(2_000)) for _ in range(20)]
    _, weights, words = model(texts, 2)
    changed = 0
    for _ in range(50):
        a, b = (f"rare{r.randrange(20_000)}" for _ in range(2))
        one, two = f"so {a} the {b} it", f"so {b} the {a} it"
        changed += abs(mean_score(weights, words, one) - mean_score(weights, words, two)) > 1e-6
    assert changed >= 48


def test_gradients_match_finite_differences():
    r = np.random.default_rng(1)
    counts = r.integers(1, 50, 1 << 16)
    words = lm.lexicon(counts)
    weights = lm.initial(counts, words)
    slots = r.integers(0, 1 << 16, 20)
    around = np.stack([r.permutation(lm.ROWS)[:20] for _ in lm.OFFSETS]).astype(np.uint16)
    every = lm.Tokens(words.class_[slots], words.leaf[slots], around, words.share[slots])
    moved = {k: v.copy() for k, v in weights.items()}
    lm.descend(moved, every, 1e-3)
    deep = int(next(c for c in every.class_ if c >= lm.ALONE))
    same = [i for i, c in enumerate(every.class_) if c == deep]
    cases = [("out", (3, int(every.class_[0])), 20), ("hidden", (5,), 20), ("embed", (1, int(around[1, 4]), 7), 1),
             ("deep", (deep, 3, int(every.leaf[same[0]])), len(same)), ("deep_bias", (deep, int(every.leaf[same[0]])), len(same))]
    for name, at, n in cases:
        def loss(d):
            own = {k: v.astype(np.float64) for k, v in weights.items()}
            own[name][at] += d
            hidden = np.tanh(sum(own["embed"][i][around[i]] for i in range(4)) + own["hidden"])
            logits = hidden @ own["out"] + own["bias"]
            total = (logits[np.arange(20), every.class_] - np.log(np.exp(logits).sum(1))).sum()
            for i, c in enumerate(every.class_):
                if c >= lm.ALONE:
                    x = hidden[i] @ own["deep"][c] + own["deep_bias"][c]
                    total += x[every.leaf[i]] - np.log(np.exp(x).sum())
            return -total
        slope = (loss(1e-4) - loss(-1e-4)) / 2e-4
        assert weights[name][at] - moved[name][at] == pytest.approx(1e-3 / math.sqrt(n) * slope, rel=0.05, abs=1e-6)


@pytest.mark.parametrize("bits", [16, 18])
def test_all_slots_together_have_probability_one(bits):
    counts = np.random.default_rng(2).zipf(1.5, 1 << bits).clip(0, 10**6)
    words = lm.lexicon(counts)
    weights = lm.initial(counts, words)
    slots = np.arange(1 << bits)
    around = np.repeat(np.array([[3], [lm.ROWS], [700], [4000]], np.uint16), len(slots), 1)
    every = lm.Tokens(words.class_[slots], words.leaf[slots], around, words.share[slots])
    assert np.exp(lm.token_scores(weights, every).astype(np.float64)).sum() == pytest.approx(1, abs=1e-3)


def test_every_token_is_scored_from_both_sides():
    words = lm.lexicon(counted(["a b c d a b a"]))
    every = lm.in_context(lm.tokens(["a b c", "", "d"]), words.packed())
    (abc, d), pad = (words.row[words.slots(np.concatenate(lm.tokens([t])))].tolist() for t in ("a b c", "d")), lm.ROWS
    a, b, c = abc
    assert every.around.T.tolist() == [[pad, pad, b, c], [pad, a, c, pad], [a, b, pad, pad], [pad] * 4]
    assert len(every.class_) == 4 and d


def test_slots_grow_with_the_vocabulary(spark, table, run):
    for n, most, bits in ((10, 1 << 22, 16), (60_000, 1 << 22, 17), (60_000, 1 << 16, 16)):
        texts = [" ".join(f"w{i}" for i in range(at, min(at + 500, n))) for at in range(0, n, 500)] * 2
        words = lm.word_counts(lm.tokenize(table(list(enumerate(texts)), DOC)), held=1_000)
        assert words.count() == pytest.approx(n, abs=3) and {r.n for r in words.collect()} <= {2, 4}
        counts = lm.slot_counts(words, most)
        assert len(counts) == 1 << bits and counts.sum() == 2 * n


def test_table_scores_are_the_models(spark, run):
    folder = "/root/testdata/sf0.001"
    rows = {r.doc_id: r.text for r in documents(spark, folder).collect()}
    got = {r.doc_id: r for r in lm.op8_pseudo_likelihood(spark, folder).collect()}
    tokenized = run.write(lm.tokenize(documents(spark, folder)), "tokens")
    counts = lm.slot_counts(lm.word_counts(tokenized))
    assert (counts == counted(list(rows.values()), int(math.log2(len(counts))))).all()
    words = lm.lexicon(counts)
    weights = lm.train(tokenized, words, counts)
    for i in sorted(rows, key=lambda i: (len(rows[i]), i))[:12]:
        assert got[i].n_tokens == len(lm.tokens([rows[i]])[0])
        assert got[i].log_likelihood == pytest.approx(plain_score(weights, words, rows[i]), rel=2e-3, abs=1e-2)
    unigram = np.log((counts + 0.1) / (counts + 0.1).sum())
    plain = sum(unigram[words.slots(s)].sum() for s in lm.tokens(list(rows.values())))
    assert sum(r.log_likelihood for r in got.values()) > plain


def test_training_predicts_every_token_and_averages_what_moved(table, run):
    texts = ["one two three four five six seven eight nine ten"] * 3 + ["short text", ""]
    counts = counted(texts)
    words = lm.lexicon(counts)
    start = lm.initial(counts, words)

    def alone(some):
        own = {k: v.copy() for k, v in start.items()}
        lm.descend(own, lm.in_context(lm.tokens(some), words.packed()), lm.RATE)
        return own
    rows = table(list(enumerate(texts)), DOC)
    got = lm.train(run.write(lm.tokenize(rows.coalesce(1)), "tokens"), words, counts, rounds=1)
    want = alone(texts)
    assert all(got[k] == pytest.approx(want[k], abs=2e-6) for k in want)
    halves = [run.write(lm.tokenize(table([(i, t)], DOC).coalesce(1)), "tokens") for i, t in enumerate(("one two three", "one four"))]
    got = lm.train(halves[0].union(halves[1]), words, counts, rounds=1)
    one, two = alone(["one two three"]), alone(["one four"])
    flat = [lm.flat(w).reshape(-1, lm.BLOCK) for w in (start, one, two, got)]
    moved = [(f != flat[0]).any(1) for f in flat[1:3]]
    n = np.maximum(moved[0].astype(int) + moved[1], 1)[:, None]
    want = np.where((moved[0] | moved[1])[:, None], (flat[1] * moved[0][:, None] + flat[2] * moved[1][:, None]) / n, flat[0])
    assert flat[3] == pytest.approx(want, abs=2e-6) and (moved[0] != moved[1]).any()


def test_nulls_repeats_extra_columns_and_empty_tables(table, run):
    rows = [(None, "the cat"), (1, None), (2, "the cat"), (2, "the cat"), (3, "..."), (4, "word " * 100_000)]
    got = lm.score_documents(table(rows, DOC), run).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == [
        ("1", 0), ("2", 2), ("2", 2), ("3", 0), ("4", 100_000), ("None", 2)]
    assert all((r.mean_log_likelihood is None) == (r.n_tokens == 0) for r in got)
    wide = table([r + (1, "s") for r in rows], DOC + ", n_tokens int, words string")
    assert lm.score_documents(wide, run).count() == 6
    assert lm.score_documents(table([], DOC), run).collect() == []


def test_a_batch_moves_embeddings_by_the_slopes_over_the_root_of_their_tokens():
    r = np.random.default_rng(3)
    size = lm.BATCH + 700
    counts = r.integers(0, 1000, 1 << 16)
    words = lm.lexicon(counts)
    every = lm.Tokens(
        r.integers(0, lm.CLASSES, size).astype(np.uint8), np.zeros(size, np.uint8),
        np.minimum(r.zipf(1.3, (4, size)) - 1, lm.ROWS).astype(np.uint16), np.zeros(size, np.float32))
    every.leaf[every.class_ >= lm.ALONE] = r.integers(0, lm.LEAVES, int((every.class_ >= lm.ALONE).sum()))
    got, plain = lm.initial(counts, words), lm.initial(counts, words)
    lm.descend(got, every, 0.07)
    plain = {k: v.astype(float) for k, v in plain.items()}
    for lo in range(0, size, lm.BATCH):
        own = every.part(lo, lm.BATCH)
        n = len(own.class_)
        hidden = np.tanh(sum(plain["embed"][i][own.around[i]] for i in range(4)) + plain["hidden"])
        error = np.exp(hidden @ plain["out"] + plain["bias"])
        error /= error.sum(1, keepdims=True)
        error[np.arange(n), own.class_] -= 1
        back = error @ plain["out"].T
        moved = {"out": hidden.T @ error / np.sqrt(n), "bias": error.sum(0) / np.sqrt(n)}
        for c in range(lm.ALONE, lm.CLASSES):
            at = np.flatnonzero(own.class_ == c)
            wrong = np.exp(hidden[at] @ plain["deep"][c] + plain["deep_bias"][c])
            wrong /= wrong.sum(1, keepdims=True)
            wrong[np.arange(len(at)), own.leaf[at]] -= 1
            back[at] += wrong @ plain["deep"][c].T
            plain["deep"][c] -= 0.07 * hidden[at].T @ wrong / np.sqrt(max(len(at), 1))
            plain["deep_bias"][c] -= 0.07 * wrong.sum(0) / np.sqrt(max(len(at), 1))
        for name, by in moved.items():
            plain[name] -= 0.07 * by
        back *= 1 - hidden**2
        plain["hidden"] -= 0.07 * back.sum(0) / np.sqrt(n)
        for i, rows in enumerate(own.around):
            slopes = np.zeros(plain["embed"][i].shape)
            np.add.at(slopes, rows, back)
            plain["embed"][i] -= 0.07 * slopes / np.sqrt(np.maximum(np.bincount(rows, minlength=lm.ROWS + 1), 1))[:, None]
    for name in got:
        assert np.abs(got[name] - plain[name]).max() < 1e-4, name


@pytest.mark.parametrize("size", [0, 1, lm._SMALL - 1, lm._SMALL, 3 * lm._SMALL + 5])
def test_products_by_slices_are_plain_products(size):
    r = np.random.default_rng(4)
    a, b, c = (r.standard_normal(s).astype(np.float32) for s in ((size, lm.HIDDEN + 1), (lm.HIDDEN + 1, lm.CLASSES), (size, lm.CLASSES)))
    assert lm._times(a, b) == pytest.approx(a.astype(float) @ b, abs=1e-4)
    assert lm._over_rows(a, c) == pytest.approx(a.T.astype(float) @ c, abs=1e-3)


def test_a_batch_of_classes_of_one_leaf_moves_no_leaves_and_huge_logits_stay_finite():
    r = np.random.default_rng(5)
    counts = r.integers(0, 1000, 1 << 16)
    words = lm.lexicon(counts)
    start = lm.initial(counts, words)
    start["out"] *= 10_000
    every = lm.Tokens(r.integers(0, lm.ALONE, 50).astype(np.uint8), np.zeros(50, np.uint8),
                      r.integers(0, lm.ROWS, (4, 50)).astype(np.uint16), np.zeros(50, np.float32))
    moved = {k: v.copy() for k, v in start.items()}
    lm.descend(moved, every, 0.07)
    assert all(np.isfinite(w).all() for w in moved.values()) and np.isfinite(lm.token_scores(moved, every)).all()
    assert (moved["deep"] == start["deep"]).all() and (moved["embed"] != start["embed"]).any()
    rows = (moved["embed"] != start["embed"]).any(2)
    assert all(set(np.flatnonzero(rows[i])) <= set(every.around[i].tolist()) for i in range(4))
