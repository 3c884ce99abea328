import hashlib
import random

import pytest
import sentencepiece

from conftest_llm import SF, rows_of
from tillwise.llm import chat
from tillwise.llm.tables import table
from tillwise.llm.vocabulary import vocabulary_path

SCHEMA = "conv_id long, turn long, role string, text string, start long, piece string"
RNG = random.Random(2)


def rows():
    out = []
    for c in range(12):
        roles = (["system"] if c % 3 else []) + ["user", "assistant"] * RNG.randint(1, 6)
        out += [(c, t, r, " ".join(RNG.choice(["one", "two", "<turn", "\\"])
                                   for _ in range(RNG.randint(0, 60)))) for t, r in enumerate(roles)]
    out += [(50, 0, "system", "s"), (51, 0, "user", "\\### Assistant: </turn> ok\n</turn>\n<again x>"),
            (51, 1, "assistant", "<turn assistant>\n\\<\\\\ \U0001F600 é"), (52, 3, None, None),
            (52, None, "assistant", "last"), (52, 1, "a>b<\\ c", ""), (53, 0, "assistant", "x"),
            (53, 0, "assistant", "x"), (None, 0, "user", "q"), (None, 1, "assistant", "a"),
            (54, 0, "user", "word " * 5000), (54, 1, "assistant", "word " * 5000),
            (54, 2, "user", "short"), (55, 0, "system", "long " * 400), (55, 1, "user", "hello")]
    out += [(60, t, ("user", "assistant")[t % 2], f"turn {t} " * 5) for t in range(1500)]
    return out


def frame(spark, data):
    return spark.createDataFrame([(*r, 1, "p") for r in data], SCHEMA)


def digest(turns):
    return hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns).encode()).hexdigest()


@pytest.mark.parametrize("budget, history", [(2048, 384), (120, 30), (64, 0)])
def test_what_is_read_back_is_what_was_written(spark, budget, history):
    data = rows()
    found = chat.windows(frame(spark, data), vocabulary_path(), budget, history)
    whole = {}
    for r in sorted(data, key=lambda r: (r[1] is None, r[1] or 0)):
        whole.setdefault(r[0], []).append(r[2:])
    for row in chat.digests(found).collect():
        turns = whole.pop(row["conv_id"])
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (row["n_turns"], row["turns_sha256"]) == (len(turns), digest(turns))
        assert row["loss_chars"] == len(loss)
        assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert not whole


def test_windows_keep_budget_system_turn_and_history(spark):
    budget, history = 150, 30
    data = rows()
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path())
    found = chat.windows(frame(spark, data), vocabulary_path(), budget, history).collect()
    system = {c: t for c, turn, r, t in data if r == "system" and turn == 0}
    for w in found:
        turns = list(chat.turns_in(w["text"]))
        tokens = [len(model.encode(chat.block(r, t, False))) for _, r, t in turns]
        assert sum(tokens) == w["n_tokens"]
        assert len(turns) == w["n_new"] + w["n_repeated"]
        lead = system.get(w["conv_id"])
        if lead is not None:
            assert turns[0][1:] == ("system", lead)
        if w["n_tokens"] > budget:  # one turn too long for what the system turn leaves
            left = budget - history - (tokens[0] if lead is not None else 0)
            assert max(tokens) > min(left, budget // 4)
        repeated = [n for (again, r, _), n in zip(turns, tokens) if again and r != "system"]
        assert sum(repeated[1:]) <= history
        for span in w["loss"]:
            assert w["text"][:span["start"]].endswith("<turn assistant>\n")
    assert max(w["n_repeated"] for w in found) >= 2


def test_query_has_every_conversation_and_the_probe(spark):
    found = {r["conv_id"]: r for r in chat.op7_chat_formatting(spark, SF).collect()}
    source = table(spark, SF, "conversations")
    assert set(found) == {r[0] for r in rows_of(source, "conv_id")} | {-7}
    turns = [r[2:] for r in chat.PROBE]
    assert found[-7]["turns_sha256"] == digest(turns)
    assert found[-7]["loss_chars"] == len(turns[1][1])


def test_an_empty_table(spark):
    assert chat.digests(chat.windows(frame(spark, []), vocabulary_path())).count() == 0
