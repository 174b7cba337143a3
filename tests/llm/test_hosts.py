import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from admesh.llm import hosts

PAGE = "page_id bigint, url string, html string"


@pytest.mark.parametrize("url, host, path", [
    ("http://A.Example.com/en/x?y#z", "a.example.com", "/en/x"), ("https://h#f", "h", ""), ("x", "", ""),
    ("a://b://c/d", "b:", "//c/d"), ("://Ä.DE/ß", "Ä.de", "/ß"), ("http://h?q=://z/", "h", ""), ("", "", ""),
    (None, "", ""), ("a\n://h/p\nq?r", "h", "/p\nq"), ("http:///p", "", "/p")])
def test_host_and_path(table, url, host, path):
    row = table([(url,)], "u string").select(hosts.host_of(F.col("u")).alias("h"), hosts.path_of(F.col("u")).alias("p"))
    assert tuple(row.first()) == (host, path)


@pytest.mark.parametrize("host, path, rule", [
    ("a.net", "/", "net/"), ("net", "/x", "net/"), ("anet", "/", None), ("example.net", "/en/1", "example.net/en/"),
    ("m.example.net", "/en", "net/"), ("x.example.com", "/de/", "example.com/de/"), ("example.com", "/en/", None),
    ("a.org", "/fr/", "org/fr/"), ("a.net", "", None), ("example.netx", "/en/", None)])
def test_the_longest_fitting_rule_wins(table, host, path, rule):
    got = table([(host, path)], "h string, p string").select(hosts.matching_rule(F.col("h"), F.col("p")).alias("r")).first().r
    assert (got and got.rule) == rule


def brute(outcomes, limit, z=hosts.Z):
    """The same hierarchy in plain Python."""
    n, k = Counter(h for h, _ in outcomes), Counter(h for h, b in outcomes if b)
    domain, suffix = {}, {}
    for host in n:
        parts = re.sub(r":\d*$", "", host.split("@")[-1]).split(".")
        labels = 2 if ".".join(parts[-2:]) in hosts.SUFFIXES else 1
        if len(parts) == 4 and all(p.isdigit() for p in parts):
            labels = 4
        suffix[host], domain[host] = ".".join(parts[-labels:]), ".".join(parts[-labels - 1:])

    def level(name):
        return Counter({g: sum(n[h] for h in n if name[h] == g) for g in name.values()}), Counter(
            {g: sum(k[h] for h in n if name[h] == g) for g in name.values()})

    def shrink(counts, p):
        n, k = counts
        spread = sum(n[g] * (k[g] / n[g] - p[g]) ** 2 - p[g] * (1 - p[g]) for g in n)
        room = sum(p[g] * (1 - p[g]) * (n[g] - 1) for g in n)
        strength = 1 / min(0.5, max(1e-4, spread / room if room else 0)) - 1
        return {g: (k[g] + strength * p[g]) / (n[g] + strength) for g in n}, strength
    s, _ = shrink(level(suffix), dict.fromkeys(suffix.values(), sum(k.values()) / sum(n.values())))
    d, _ = shrink(level(domain), {domain[h]: s[suffix[h]] for h in n})
    rate, m = shrink((n, k), {h: d[domain[h]] for h in n})
    return {h: rate[h] - z * math.sqrt(rate[h] * (1 - rate[h]) / (n[h] + m + 1)) for h in n}


@pytest.mark.parametrize("seed", [1, 2])
def test_reputation_matches_brute_force(table, run, seed):
    r = random.Random(seed)
    outcomes = []
    for i in range(25):
        p = r.choice([0.02, 0.1, 0.9])
        name = f"{r.choice('ab')}{i}.{r.choice(['x', 'y', 'z'])}.{r.choice(['com', 'org', 'co.uk', 'uk'])}{r.choice(['', ':8080'])}"
        name = r.choice([name, name, name, "me@" + name, f"10.0.{i % 3}.1{r.choice(['', ':80'])}"])
        outcomes += [(name, r.random() < p) for _ in range(r.choice([1, 3, 40, 200]))]
    got = {x.host: x for x in hosts.reputation(table(outcomes, "host string, bad boolean"), run).collect()}
    want = brute(outcomes, hosts.LIMIT)
    assert {h: x.bound for h, x in got.items()} == pytest.approx(want, abs=1e-6)
    assert {h for h, x in got.items() if x.verdict == "block"} == {h for h, b in want.items() if b > hosts.LIMIT} != set()


@pytest.mark.parametrize("host, suffix, domain", [
    ("a.b.com", "com", "b.com"), ("a.b.co.uk", "co.uk", "b.co.uk"), ("co.uk", "co.uk", "co.uk"), ("a.b.uk", "uk", "b.uk"),
    ("a.b.com:8080", "com", "b.com"), ("me:pw@a.b.com:80", "com", "b.com"), ("10.0.0.1:80", "10.0.0.1", "10.0.0.1"),
    ("[::1]:80", "[::1]", "[::1]"), ("", "", ""), ("local", "local", "local"), ("1.2.3", "3", "2.3")])
def test_suffix_and_domain(table, host, suffix, domain):
    row = table([(host,)], "h string").select(hosts.suffix_and_domain(F.col("h")).alias("s")).first().s
    assert tuple(row) == (suffix, domain)


def test_suffix_rules_and_outcomes_are_parameters(table, run):
    rows = [(i, f"http://h{i}.deep.city.example.jp/", "x") for i in range(30)] + [(99, "http://a.other.jp/", "x")]
    docs = table(rows, PAGE)
    got = {r.page_id: r for r in hosts.judge_urls(docs, run, suffixes=("city.example.jp",), bad=F.col("page_id") < 30).collect()}
    assert got[3].verdict == "block" and got[99].bound < got[3].bound
    name = table([("a.deep.city.example.jp",)], "h string").select(
        hosts.suffix_and_domain(F.col("h"), ("city.example.jp", "example.jp")).alias("s")).first().s
    assert tuple(name) == ("city.example.jp", "deep.city.example.jp")


def test_few_pages_are_judged_by_their_relatives(table, run):
    outcomes = [(f"h{i}.bad.com", True) for i in range(60)] + [(f"h{i}.good.com", False) for i in range(60)]
    outcomes += [("new.good.com", True)]
    got = {x.host: x for x in hosts.reputation(table(outcomes, "host string, bad boolean"), run).collect()}
    assert got["h1.bad.com"].verdict == "block" and got["new.good.com"].bound < got["h1.bad.com"].bound


def test_nulls_repeats_extra_columns_and_empty_tables(table, run):
    rows = [(1, None, None), (1, None, None), (None, "http://a.net/x", ""), (3, "http://a.org/fr/", "$$$ $$$")]
    plain = sorted(map(str, hosts.judge_urls(table(rows, PAGE), run).collect()))
    assert len(plain) == 4
    extra = table([r + ("h", 1, "v") for r in rows], PAGE + ", host string, n int, verdict string")
    assert sorted(map(str, hosts.judge_urls(extra, run).collect())) == plain
    assert hosts.judge_urls(table([], PAGE), run).collect() == []
    html = table([("$$$ word",), ("",), (None,), ("plain words " * 9,)], "html string")
    assert [x[0] for x in html.select(hosts.is_bad(F.col("html"))).collect()] == [True, False, False, False]
