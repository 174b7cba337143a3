import random
import re

import pytest

from admesh.llm import license_rules, licenses
from admesh.llm.tables import table as scan_table

DOC = "doc_id bigint, text string"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_base(text):
    """Places of the base phrases, by comparing words."""
    own = words(text)
    return [(i, label) for phrase, label in license_rules.BASE for p in [phrase.split()]
            for i in range(len(own) - len(p) + 1) if own[i:i + len(p)] == p]


def brute_detections(text):
    """Every rule without a prefilter, suppressed by comparing all detections with each other."""
    own = words(text)
    line = f" {' '.join(own)} "
    kept = []
    for rule in license_rules.rules():
        found = []
        for m in rule.pattern.finditer(line):
            start = line[:m.start()].count(" ") - 1
            span = start, start + len(m[0].split(" "))
            if rule.base or not any(s <= span[0] and span[1] <= e for _, _, s, e in kept):
                found.append((rule.label, rule.name, *span))
        kept += found
    return kept


def row_of(text):
    base, all_ = brute_base(text), brute_detections(text)
    sure = {r.name: r.confidence for r in license_rules.rules()}
    return (len(words(text)), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None),
            ",".join(sorted({x for _, x in base})), ",".join(sorted({d[0] for d in all_})),
            max((sure[d[1]] for d in all_), default=0.0))


COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def got(df):
    return sorted(((r.doc_id, tuple(r[c] for c in COLUMNS)) for r in df.collect()), key=str)


def labels(text):
    return {d.label for d in licenses.detect(licenses.normalised(text.encode())[1])}


@pytest.mark.parametrize("text, want", [
    ("Released under the MIT License.", {"mit"}),
    ("Licensed under the Apache License, Version 2.0.", {"apache-2"}),
    ("Licensed under CC BY-NC 4.0.", {"cc-by-nc"}),
    ("This work is licensed under the GNU General Public License, version 3.", {"gpl-3"}),
    ("distributed under the terms of the GNU Lesser General Public Licence v2.1", {"lgpl-2.1"}),
    ("under the GNU Lesser General Public License", {"lgpl"}),
    ("GNU Affero General Public License, version 3.0", {"agpl-3"}),
    ("// SPDX-License-Identifier: BSD-3-Clause", {"bsd-3"}),
    ("see https://creativecommons.org/licenses/by-sa/4.0/", {"cc-by-sa"}),
    ("CC-BY 4.0", {"cc-by"}), ("CC0 1.0 Universal", {"cc0"}), ("GPLv3 or later", {"gpl-3"}), ("AGPLv3", {"agpl-3"}),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", {"mit"}),
    ("Neither the name of the University nor the names of its contributors may be used to endorse or promote products",
     {"bsd-3"}),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", {"mpl-2"}),
    ("Distributed under the Boost Software License, Version 1.0.", {"boost-1"}),
    ("Copyright 2020. All rights reserved.", {"all-rights-reserved"}),
    ("a permit, a license plate, the omitted general and an apache helicopter", set()),
    ("he is under arrest; the driver's license expired", set()), ("", set())])
def test_known_notices(text, want):
    assert labels(text) == want


def test_there_are_hundreds_of_rules_with_sound_keywords():
    rules = license_rules.rules()
    assert len(rules) > 300 and len({r.name for r in rules}) > 280
    assert all(len(k) >= 3 for r in rules for k in r.keywords)
    assert [license_rules.keyword(b) for b in ("(?:gnu )?gpl ?v?3(?: 0)?", "a licen[sc]es? v1", "neither (?:\\S+ ){1,12}?used to x")] == [
        "gpl", " a licen", "used to x "]


@pytest.mark.parametrize("seed", [1, 2])
def test_prefilter_and_suppression_agree_with_brute_force(table, seed):
    r = random.Random(seed)
    stems = [p for p, _ in license_rules.BASE] + [
        "licensed under", "the gnu", "lesser general public license", "version 3", "apache license version 2 0", "cc by nc sa 4 0",
        "mit license", "spdx license identifier mpl 2 0", "bsd 3 clause", "neither the name of x nor y used to endorse or promote products",
        "opensource org licenses mit", "all rights reserved", "release", "und", "Ünder", "gpl v3", "cc", "by", "nc", "0"]
    rows = [(i, r.choice([" ", ", ", "\n"]).join(
        w.upper() if r.random() < 0.2 else w for w in r.choices(stems, k=r.randrange(25)))) for i in range(250)]
    assert got(licenses.summary(licenses.scan(table(rows, DOC).repartition(4)))) == sorted(
        ((i, row_of(t)) for i, t in rows), key=str)
    found = licenses.spans(licenses.scan(table(rows, DOC))).collect()
    assert sorted((d.doc_id, d.label, d.rule, d.start, d.end) for d in found) == sorted(
        (i, *d) for i, t in rows for d in brute_detections(t))


def test_a_table_of_documents_matches_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in scan_table(spark, folder, "documents").collect()]
    assert got(licenses.op12_license_scan(spark, folder)) == sorted(((i, row_of(t)) for i, t in rows), key=str)


def test_planted_lines_are_labelled_and_other_documents_are_not(spark):
    folder = "/root/testdata/sf0.01"
    planted = re.compile("is licensed under the GNU General|Licensed under CC BY-NC|under the MIT License|under the Apache License|"
                         "All rights reserved")
    texts = {r.doc_id: r.text for r in scan_table(spark, folder, "documents").collect()}
    for r in licenses.op12_license_scan(spark, folder).collect():
        assert (r.labels != "") == bool(planted.search(texts[r.doc_id] or "")) and (r.score > 0) == (r.labels != "")


def test_nulls_repeats_long_texts_extra_columns_and_empty_tables(table):
    mit = "Under the MIT License"
    long = "word " * 300_000 + (mit + " ") * 20_000 + "y" * 1_000_000
    rows = [(None, mit), (1, mit), (1, mit), (2, None), (3, ""), (4, long)]
    plain = licenses.summary(licenses.scan(table(rows, DOC)))
    want = {None: (4, 1, 0, 0, "mit", "mit", 1.0), 2: (0, 0, None, None, "", "", 0.0),
            4: (380_001, 20_000, 300_000, 379_996, "mit", "mit", 1.0)}
    assert got(plain) == sorted([(i, want[{1: None, 3: 2}.get(i, i)]) for i, _ in rows], key=str)
    wide = table([r + (9, "x") for r in rows], DOC + ", n_words int, detections string")
    assert got(licenses.summary(licenses.scan(wide))) == got(plain)
    assert licenses.summary(licenses.scan(table([], DOC))).collect() == []
