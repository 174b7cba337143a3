import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from admesh.llm import pii
from admesh.llm.tables import documents

DOC = "doc_id bigint, text string"


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def base(text):
    return [(k, m.start(), m.end()) for k, (p, ok) in PATTERNS.items() for m in re.finditer(p, text or "") if ok(m[0])]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def odd_texts():
    r = random.Random(1)
    bits = ["a@b.c", "@", ".", "x.y", "-", "é", " ", "+", "12", "4111 1111 1111 1111", "4111111111111111", "255", "256",
            "1.2.3.4", "0300.1.1.1", "+1 (234) 555-7890", "(", ")", "_", "\n", "日", "007", "a@b", "5-5", "%", "٣"]
    return ["".join(r.choice(bits) for _ in range(r.randrange(14))) for _ in range(1500)]


def spans_of(df, column="base"):
    return {r.doc_id: [tuple(s) for s in r[column]] for r in df.collect()}


def test_base_spans_match_the_plain_patterns(table, run):
    rows = list(enumerate(odd_texts()))
    got = spans_of(pii.find_spans(table(rows, DOC).repartition(4), run))
    assert got == {i: base(t) for i, t in rows}


def test_documents_match_the_plain_patterns(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in documents(spark, folder).collect()}
    for r in pii.op9_pii(spark, folder).collect():
        want = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w[0] == k for w in want) for k in pii.KINDS[:4]]
        assert set(filter(None, listed(want).split(","))) <= set(r.spans.split(","))


def test_em_finds_the_reliable_labellers():
    r = random.Random(2)
    rates = [(0.95, 0.95), (0.9, 0.8), (0.6, 0.6), (0.9, 0.95), (0.55, 0.5)]
    counts, truth = {}, {}
    for _ in range(20_000):
        kind, true = r.choice(pii.KINDS), r.random() < 0.4
        votes = tuple(int(r.random() < hit) if true else int(r.random() > calm) for hit, calm in rates)
        counts[kind, votes] = counts.get((kind, votes), 0) + 1
        truth[kind, votes] = truth.get((kind, votes), 0) + true
    patterns = [(k, v, n) for (k, v), n in sorted(counts.items())]
    posterior, accuracy = pii.estimate(patterns)
    for i, (hit, calm) in enumerate(rates):
        assert accuracy[i][1][1] == pytest.approx(hit, abs=0.04) and accuracy[i][0][0] == pytest.approx(calm, abs=0.04)
    weights = pii.fit_classifier(patterns, posterior)
    right = total = 0
    for k, v, n in patterns:
        yes = sum(w * x for w, x in zip(weights, pii._features(k, v))) > 0
        right += truth[k, v] if yes else n - truth[k, v]
        total += n
    assert right / total > 0.95


def test_the_classifier_adds_secrets_and_keeps_the_base(spark, run):
    folder = "/root/testdata/sf0.1"
    texts = {r.doc_id: r.text for r in documents(spark, folder).collect()}
    rows = pii.find_spans(documents(spark, folder), run).collect()
    added = [(texts[r.doc_id], s) for r in rows for s in r.spans if s not in r.base]
    secrets = sum(len(re.findall(r'token = "[0-9a-f]{32,}"', t)) for t in texts.values())
    assert sum(s.kind == "secret" for _, s in added) >= 0.95 * secrets > 0
    assert all(re.search("[0-9]", t[s.start:s.stop]) for t, s in added)
    assert all(set(r.base) <= set(r.spans) for r in rows)


def test_secrets_of_any_length_are_candidates():
    for n in (20, 128, 129, 5_000):
        run = ("aB3" * n)[:n]
        assert [m.span() for m in re.finditer(pii.LOOSE["secret"], f"key {run}, more")] == [(4, 4 + n)]


def test_redaction_replaces_each_span_once(table, run):
    rows = [(1, "mail a.b@c.de now\né +1 (234) 555-7890.", "en", "s", 40), (2, "nothing", "en", "s", 7),
            (2, "x 10.0.0.1", "en", "s", 10), (None, None, None, None, None), (4, "10.0.0.1.2@x.yz", "en", "s", 15)]
    docs = table(rows, DOC + ", lang string, source string, n_chars bigint")
    got = sorted((r.text or "", r.n_chars or 0) for r in pii.redact(docs, run).collect())
    assert got == sorted([("mail [EMAIL] now\né [PHONE].", 27), ("nothing", 7), ("x [IP]", 6), ("", 0), ("[EMAIL]", 7)])
    assert pii.redact(docs, run).columns == docs.columns


def test_redaction_leaves_columns_of_any_name_alone(table, run):
    names = ("spans", "all", "_row", "row", "done", "base", "kind")
    docs = table([(1, "mail a.b@c.de now", *names), (None, None, *[None] * 7)],
                 DOC + "".join(f", `{n}` string" for n in names))
    got = sorted(pii.redact(docs, run).collect(), key=str)
    assert [tuple(r) for r in got] == [(1, "mail [EMAIL] now", *names), (None,) * 9] and got[0].__fields__ == docs.columns


def test_nulls_repeats_extra_columns_and_empty_tables(table, run):
    rows = [(None, "a@b.cd"), (1, None), (1, None), (2, "a@b.cd")]
    got = pii.find_spans(table(rows, DOC), run).collect()
    assert sorted(len(r.base) for r in got) == [0, 0, 1, 1]
    wide = table([r + (1, "all") for r in rows], DOC + ", base int, `all` string")
    assert sorted(map(str, pii.find_spans(wide, run).collect())) == sorted(map(str, got))
    assert pii.find_spans(table([], DOC), run).collect() == []


def test_long_runs_neither_backtrack_nor_recurse(table, run):
    texts = ["a" * 300_000, "a." * 200_000, "1" * 300_000, "1." * 20_000, "a@" + "b." * 100_000 + "c", "1 " * 200_000,
             "+1" + " " * 300_000, "-" * 300_000]
    got = spans_of(pii.find_spans(table(list(enumerate(texts)), DOC), run))
    assert got[0] == [] and got[4] == [("email", 0, 200_003)] and len(got[3]) == 5_000


def test_the_plan_stays_native(spark):
    text = pii.op9_pii(spark, "/root/testdata/sf0.001").select(F.col("*"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)
