import random
import tracemalloc

import numpy as np
import pytest

from admesh.llm import quality
from admesh.llm.tables import table as scan

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LABEL = "doc_id bigint, quality int, toxic int"
FOLDER = "/root/testdata/sf0.1"


def test_em_recovers_the_labellers_accuracies():
    r = np.random.default_rng(1)
    truth = r.random(5000) < 0.3
    rates = [(0.9, 0.95, 1.0), (0.7, 0.8, 0.6), (0.85, 0.9, 0.8), (0.6, 0.99, 0.9)]
    votes = np.stack([np.where(r.random(5000) > seen, -1,
                               np.where(truth, r.random(5000) < hit, r.random(5000) > calm).astype(int))
                      for hit, calm, seen in rates], 1)
    posterior, accuracy = quality.label_model(votes)
    assert ((posterior > 0.5) == truth).mean() > 0.95
    for labeller, (hit, calm, seen) in enumerate(rates):
        assert accuracy[labeller, 1, 0] == pytest.approx(hit * seen, abs=0.04)
        assert accuracy[labeller, 0, 1] == pytest.approx(calm * seen, abs=0.04)


def test_held_out_accuracy(spark):
    """Fit on the first half of the labelled documents, judge the second half."""
    known = {r.doc_id: r for r in scan(spark, FOLDER, "labels").collect()}
    texts = {r.doc_id: r.text for r in scan(spark, FOLDER, "documents").collect() if r.doc_id in known}
    ids = sorted(known)
    train, test = ids[:len(ids) * 2 // 3], ids[len(ids) * 2 // 3:]

    def column(name, of):
        return np.array([known[i][name] for i in of])
    model = quality.fit(quality.summarise([texts[i] for i in train]), column("quality", train), column("toxic", train))
    scores = quality.score(model, [texts[i] for i in test])
    junk, toxic = scores["junk"] > quality.REJECT, scores["toxic"] > quality.REJECT
    bad, foul = column("quality", test) == 0, column("toxic", test) == 1
    assert junk[bad].mean() > 0.95 and junk[~bad].mean() < 0.01
    assert toxic[foul].mean() > 0.65 and toxic[~foul].mean() < 0.01
    english = np.array([any(w in texts[i].lower().split() for w in quality.INSULTS) for i in test])
    assert (toxic | junk)[english].mean() > 0.9


def toy(n=120):
    r = random.Random(2)
    words = ["river", "stone", "under", "light", "paper", "green", "walks", "table", "quiet", "morning"]
    rows, labels = [], []
    for i in range(n):
        text = " ".join(r.choice(words) + r.choice("abcdefghij") for _ in range(60))
        if i % 6 == 0:
            text += " idiot scum"
        if i % 7 == 0:
            text = " ".join(w + "$$$" for w in text.split())
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, int(i % 7 != 0), int(i % 6 == 0)))
    return rows, labels


def test_rejected_rows_go_and_the_rest_is_unchanged(table):
    rows, labels = toy()
    docs = table(rows, DOC).repartition(3)
    got = sorted(tuple(r) for r in quality.keep_good(docs, table(labels, LABEL)).collect())
    assert got == [r for r in rows if r[0] % 6 and r[0] % 7]


def test_nulls_repeats_long_texts_and_clashing_columns(table):
    rows, labels = toy()
    rows += [(None, None, None, None, None), (900, "", "en", "s", 0), (901, rows[1][1], "en", "s", 1),
             (901, rows[1][1], "en", "s", 1), (902, rows[1][1] * 3000, "en", "s", 1)]
    labels += [(None, 0, 1), (1, None, None), (5, 1, 0), (5, 1, 0)]
    got = quality.judge(table(rows, DOC), table(labels, LABEL)).collect()
    assert len(got) == len(rows)
    assert all(r.kept for r in got if r.doc_id in (901, 902))
    clash = table([r + (1.0, "x") for r in rows], DOC + ", toxic double, kept string")
    again = quality.judge(clash, table(labels, LABEL))
    assert again.columns == DOC.replace(" bigint", "").replace(" string", "").split(", ") + ["junk", "toxic", "kept"]
    assert {str(r.doc_id) + str(r.kept) for r in again.collect()} == {str(r.doc_id) + str(r.kept) for r in got}


def test_kept_rows_keep_columns_that_the_judgement_would_replace(table):
    rows, labels = toy()
    names = DOC + ", kept string, junk string, toxic int, kept_ int"
    docs = table([r + (f"k{r[0]}", "j", r[0], -r[0]) for r in rows], names)
    got = sorted(map(tuple, quality.keep_good(docs, table(labels, LABEL)).collect()))
    assert got == [r + (f"k{r[0]}", "j", r[0], -r[0]) for r in rows if r[0] % 6 and r[0] % 7]


def test_empty_tables_and_no_labels(table):
    rows, _ = toy()
    assert quality.judge(table([], DOC), table([], LABEL)).collect() == []
    got = {r.doc_id: r.kept for r in quality.judge(table(rows, DOC), table([], LABEL)).collect()}
    assert got[1] and not got[7]  # shape alone, without labels


def test_the_query_returns_the_kept_documents(spark):
    got = quality.op7_quality(spark, "/root/testdata/sf0.001").collect()
    assert 100 < len(got) < 200 and all(r.kept and r.toxic < quality.REJECT for r in got)


def test_summaries_as_columns_fit_alike_in_little_memory():
    r = np.random.default_rng(5)
    texts = [" ".join(r.choice(["plain", "words", "idiot", "$$$", "other", "more"], 30)) for _ in range(60)]
    rows = quality.summarise(texts)
    known, toxic = r.integers(0, 2, 60), r.integers(0, 2, 60)
    one = quality.fit(rows, known, toxic)
    two = quality.fit_columns(
        np.array([x["words"] for x in rows]), np.stack([x["shape"] for x in rows]), np.concatenate([x["slots"] for x in rows]),
        np.array([len(x["slots"]) for x in rows]), known, toxic)
    for name in ("junk", "toxic"):
        assert one[name]["bias"] == two[name]["bias"] and (one[name]["weights"] == two[name]["weights"]).all()

    slot = r.integers(0, 1 << quality.BITS, 8_000_000).astype(np.int32)
    doc = np.zeros(len(slot), np.int32)
    tracemalloc.start()
    yes, no = quality._odds(doc, slot, np.array([0.25]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < slot.nbytes
    counts = np.bincount(slot, minlength=1 << quality.BITS)
    assert (yes == counts / 4).all() and (no == counts * 0.75).all()
