import hashlib
import random

import numpy as np
import pytest

from admesh.llm import pieces

DOC = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder()


def all_paths(vocab, text):
    """Every segmentation of a short text with its cost, by exhaustive recursion."""
    def go(at):
        if at == len(text):
            yield 0, []
        for length in range(1, min(vocab.longest, len(text) - at) + 1):
            found = vocab.pieces.get(text[at:at + length])
            arcs = [(found[1], [found[0]])] if found else []
            if not arcs and length == 1:
                ids = vocab.spell(text[at])
                arcs = [(len(ids) * vocab.byte_cost, ids)]
            for cost, ids in arcs:
                for rest, tail in go(at + length):
                    yield cost + rest, ids + tail
    return sorted(go(0))


TEXTS = ["the", "a b", "▁ x", "été ", "\n\t", "", "  in", "日本\U0001F600", "to in\nhe"]


@pytest.mark.parametrize("text", TEXTS)
def test_n_best_match_exhaustive_search(encoder, text):
    offsets, ids, costs, alternatives = encoder.encode([text])
    want = all_paths(encoder.vocab, " " + text)
    got = [costs[0]] + [a["cost"] for a in alternatives[0]]
    assert got == [c for c, _ in want[:pieces.N_BEST]]
    segmentations = [tuple(ids.tolist())] + [tuple(pieces.edited(ids.tolist(), a["edits"])) for a in alternatives[0]]
    assert len(set(segmentations)) == len(got)
    by_ids = {tuple(i): c for c, i in want}
    assert [by_ids[s] for s in segmentations] == got
    assert all(pieces.decode(encoder.vocab, s) == text for s in segmentations)


def test_batches_agree_with_single_texts_and_round_trip(encoder):
    r = random.Random(3)
    texts = ["".join(r.choice(["the", " ", "\n", "é", "$$$ ", "in", "▁", "x" * 70, "\U0001F40D", "0"])
                     for _ in range(r.randrange(30))) for _ in range(200)]
    offsets, ids, costs, alternatives = encoder.encode(texts)
    for i, text in enumerate(texts):
        own = ids[offsets[i]:offsets[i + 1]]
        assert pieces.decode(encoder.vocab, own) == text
        _, alone, cost, other = encoder.encode([text])
        assert (own.tolist(), costs[i], alternatives[i]) == (alone.tolist(), cost[0], other[0])


def test_the_vectorised_pass_agrees_with_the_scalar_one(encoder):
    r = random.Random(4)
    segments = list({" " + "".join(r.choice("therinoué日") for _ in range(r.randrange(1, 20))) for _ in range(500)})
    flat, starts, counts, costs, gaps = encoder._best_paths(segments)
    for k, s in enumerate(segments):
        assert (flat[starts[k]:starts[k] + counts[k]].tolist(), costs[k], gaps[k]) == encoder._best_scalar(s)


def test_a_very_long_word(encoder):
    text = "xyz" * 20_000
    _, ids, _, alternatives = encoder.encode([text])
    assert pieces.decode(encoder.vocab, ids) == text and len(alternatives[0]) == pieces.N_BEST - 1


def test_documents_round_trip_with_nulls_repeats_and_extra_columns(table):
    rows = [(1, "the cat"), (1, "the cat"), (None, "x"), (3, None), (4, "")]
    got = pieces.decode_documents(pieces.encode_documents(table(rows, DOC))).collect()
    assert sorted((str(r.doc_id), r.text_sha256) for r in got) == sorted(
        (str(i), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert all(r.same for r in got)
    extra = table([r + (1, "i") for r in rows], DOC + ", cost int, ids string")
    assert pieces.encode_documents(extra).count() == 5
    assert pieces.decode_documents(pieces.encode_documents(table([], DOC))).collect() == []


def test_every_document_of_the_table_round_trips(spark):
    folder = "/root/testdata/sf0.001"
    want = {r.doc_id: r.text for r in pieces.documents(spark, folder).collect()}
    got = pieces.op2_sentencepiece(spark, folder).collect()
    assert {r.doc_id: r.text_sha256 for r in got} == {
        i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}
    assert all(r.same and len(r.costs.split(",")) == pieces.N_BEST for r in got)
    assert np.mean([r.n_pieces for r in got]) > 10


def test_verified_rows_hold_the_decoded_texts_digest(table):
    rows = [(1, "plain words é 日本"), (2, None), (3, "  two  spaces\n"), (3, "")]
    got = pieces.encode_documents(table(rows, "doc_id bigint, text string"), verify=True).collect()
    assert sorted((r.doc_id, r.text_sha256) for r in got) == sorted(
        (i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    vocab = pieces.vocabulary(pieces.MODEL)
    _, ids, _, _ = pieces.Encoder().encode(["plain words"])
    with pytest.raises(ValueError):
        pieces._verified(vocab, ["plain word"], np.array([0, len(ids)]), ids)


def test_the_encoder_keeps_a_bounded_number_of_lattices_and_none_changes_a_result():
    r = random.Random(11)
    texts = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(2_500)]
    encoder = pieces.Encoder()
    whole = encoder.encode(texts)[3]
    assert encoder._searchable.cache_info().currsize <= 2_000
    assert whole == [pieces.Encoder().encode([t])[3][0] for t in texts[:40]] + whole[40:]
