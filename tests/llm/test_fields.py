from admesh.llm import fields

DOC = "doc_id bigint, text string"


def test_fields_let_all_members_through_and_few_others(table, run, monkeypatch):
    docs = table([(i, "t") for i in range(4_000)] + [(None, "n")], DOC)
    ids = run.write(table([(i,) for i in range(0, 4_000, 40)] * 2, "doc_id bigint"), "ids")
    got = {r.doc_id for r in fields.only(docs, ids).collect()}
    assert set(range(0, 4_000, 40)) <= got and len(got) < 500
    rest = [r.doc_id for r in fields.without(docs, ids).collect()]
    assert len(rest) == 3_901 and set(rest) == {None, *range(4_000)} - set(range(0, 4_000, 40))
    monkeypatch.setattr(fields, "WORDS", 1)  # a full field lets through what it cannot tell apart
    assert set(range(0, 4_000, 40)) <= {r.doc_id for r in fields.only(docs, ids).collect()}
    assert {r.doc_id for r in fields.without(docs, ids).collect()} == set(rest)


def test_repeats_nulls_columns_and_empty_tables(table, run):
    wide = "doc_id bigint, text string, h string, bits int, id int, field string"
    rows = [(1, "a", "h", 1, 2, "f")] * 2 + [(None, None, None, None, None, None), (2, "b", "h", 1, 2, "f")]
    docs, ids = table(rows, wide), run.write(table([(2,), (None,)], "doc_id bigint"), "ids")
    assert sorted(map(str, fields.without(docs, ids).collect())) == sorted(str(r) for r in docs.collect() if r.doc_id != 2)
    none = run.write(table([], "doc_id bigint"), "ids")
    assert fields.without(docs, none).count() == 4 and fields.only(docs, none).count() == 0
    assert fields.without(table([], wide), ids).count() == 0 and fields.without(docs, ids).columns == docs.columns
