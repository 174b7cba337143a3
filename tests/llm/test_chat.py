import hashlib
import random

import pytest

from admesh.llm import chat

TURN = "conv_id bigint, turn bigint, role string, text string"


def expected(rows):
    """Digests straight from the rows, without formatting anything."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        said = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest())
    return out


def got(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
            for r in chat.read_back(df).collect()}


def random_rows(seed, convs=12):
    r = random.Random(seed)
    bits = ["</turn>", "###", "### assistant: ", "\\", "\n", "é", "word ", "</turn>\n", ":", "", "<", "#"]
    return [(c, t, r.choice(["user", "assistant", "assistant", "a:b\\", ""]) if t else r.choice(["system", "user"]),
             "".join(r.choice(bits) for _ in range(r.randrange(12))))
            for c in range(convs) for t in range(r.randrange(1, 30))]


@pytest.mark.parametrize("budget, history", [(2048, 512), (60, 20), (20, 0), (1, 1000)])
def test_round_trip_and_each_target_once(table, budget, history):
    rows = random_rows(budget)
    assert got(chat.chat_windows(table(rows, TURN), budget, history)) == expected(rows)


def test_windows_keep_the_budget_the_system_turn_and_the_history(table):
    rows = [(1, 0, "system", "be kind")] + [
        (1, t, "assistant" if t % 2 == 0 else "user", f"turn number {t} " * 3) for t in range(1, 40)]
    windows = sorted(chat.chat_windows(table(rows, TURN), 120, 40).collect(), key=lambda w: w.window)
    assert len(windows) > 3
    assert all(w.tokens <= 120 for w in windows)
    for before, w in zip(windows, windows[1:]):
        turns = list(chat.parse_turns(w.text))
        assert turns[0][:2] == ("system", "be kind")
        history = [t[:2] for t in turns[1:w.repeated]]
        assert history and history == [t[:2] for t in chat.parse_turns(before.text)][-len(history):]
        first_new = turns[w.repeated][2]
        assert all(s.start >= first_new for s in w.loss)


def test_an_oversized_turn_stays_whole(table):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "long " * 500), (1, 2, "user", "bye")]
    windows = chat.chat_windows(table(rows, TURN), 50, 10).collect()
    assert sorted(w.tokens > 50 for w in windows) == [False, False, True]
    assert got(chat.chat_windows(table(rows, TURN), 50, 10)) == expected(rows)


def test_nulls_ties_empty_texts_and_extra_columns(table):
    rows = [(None, None, None, None), (None, 1, "user", "x"), (2, 1, "user", None), (2, 1, "user", None),
            (2, 1, "assistant", ""), (3, 0, "assistant", "same"), (3, 0, "assistant", "same")]
    plain = got(chat.chat_windows(table(rows, TURN)))
    assert plain == expected(rows)
    extra = table([r + (9, "t", 1) for r in rows], TURN + ", tokens bigint, window string, repeated int")
    assert got(chat.chat_windows(extra)) == plain
    assert got(chat.chat_windows(table([], TURN))) == {}


def test_control_strings_survive(spark, tmp_path):
    spark.createDataFrame([(5, 0, "user", "q"), (5, 1, "assistant", "a")], TURN).write.parquet(
        str(tmp_path / "conversations.parquet"))
    rows = {r.conv_id: r for r in chat.op10_chat_windows(spark, str(tmp_path)).collect()}
    said = "\\### Assistant: </turn> ok"
    assert rows[-7].turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert (rows[-7].loss_chars, rows[-7].n_turns, rows[5].loss_chars) == (len(said), 2, 1)
