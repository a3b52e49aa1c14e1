import random
import re
from itertools import product

import pytest

from swipelens.llm import chat

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, cost STRING"


def brute_cost(roles):
    """Smallest cost over all legal label sequences: each turn joins one that is there or opens one."""
    best = 1 << 40
    legal = [
        (["system"] if s else []) + ["user", "assistant"] * pairs for s in (0, 1) for pairs in range(1, len(roles) + 2)
    ]

    def cost(i, at, shape):
        # Turn i goes to slot at or to a later one; slots that get no turn are insertions.
        if i == len(roles):
            return chat.INSERT * (len(shape) - 1 - at)
        found = 1 << 40
        for slot in range(max(at, 0), len(shape)):
            here = chat.RELABEL * (shape[slot] != roles[i]) + (chat.MERGE if slot == at else chat.INSERT * (slot - at - 1))
            found = min(found, here + cost(i + 1, slot, shape))
        return found

    for shape in legal:
        best = min(best, cost(0, -1, shape))
    return best


def parse(text):
    turns = re.findall(r"<\|(\w+)\|>\n(.*?)\n<\|end\|>\n", text, re.S)
    assert "".join(chat.TEMPLATE.format(role=r, text=t) for r, t in turns) == text
    return turns


def check(text, roles, texts):
    turns = parse(text)
    names = "".join(r[0] for r, _ in turns)
    assert re.fullmatch("s?(ua)+", names), names
    assert [p for _, t in turns for p in t.split("\n") if p] == [t for t in texts if t]


@pytest.mark.parametrize("length", [1, 2, 3, 4])
def test_cost_is_the_smallest(length):
    names = ["system", "user", "assistant", "?"]
    for roles in product(names, repeat=length):
        numbers = [chat.role_number(r) for r in roles]
        matrix = chat.run_matrix(numbers)
        end = min(range(4), key=lambda t: matrix[chat.START][t] + chat.INSERT * len(chat.closing(t)))
        chosen = chat.plan(numbers, chat.START, end)
        cost = sum(m[0] for m in chosen) + chat.INSERT * len(chat.closing(end))
        assert cost == brute_cost(roles), roles
        texts = [f"t{i}" for i in range(length)]
        check(chat.render(texts, chosen, chat.START, True), roles, texts)


def test_conversations_of_the_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = frame.collect()
    found = chat.format_chats(frame).collect()
    assert len(found) == len({r["conv_id"] for r in rows}) and sum(r["n_turns"] for r in found) == len(rows)
    for r in found:
        turns = sorted((t["turn"], t["role"], t["text"]) for t in rows if t["conv_id"] == r["conv_id"])
        rendered = parse(r["text"])
        assert re.fullmatch("s?(ua)+", "".join(n[0] for n, _ in rendered))
        if not r["cost"]:
            assert rendered == [(role, text) for _, role, text in turns]
        assert r["n_rendered"] == len(rendered)


@pytest.mark.parametrize("run_turns", [1, 3, 50])
def test_long_conversations_in_runs(spark, run_turns):
    draw = random.Random(run_turns)
    rows = [(c, i, draw.choice(["user", "assistant", "assistant", "system", "Human", "tool", None]), f"x{c}.{i}", "y")
            for c in (0, 1, 2) for i in range(draw.choice([1, 40, 200]))]
    found = {}
    for r in sorted(chat.format_chats(spark.createDataFrame(rows, SCHEMA), run_turns=run_turns).collect(), key=lambda r: (r["conv_id"], r["part"])):
        assert r["n_turns"] <= run_turns
        found.setdefault(r["conv_id"], []).append(r)
    for conv, parts in found.items():
        own = [r for r in rows if r[0] == conv]
        numbers = [chat.role_number(r[2]) for r in own]
        matrix = chat.run_matrix(numbers)
        want = min(matrix[chat.START][t] + chat.INSERT * len(chat.closing(t)) for t in range(4))
        assert sum(p["cost"] for p in parts) == want
        text = "".join(p["text"] for p in parts)
        check(text, None, [r[3] for r in own])
        assert len(parse(text)) == sum(p["n_rendered"] for p in parts)


def test_odd_rows(spark):
    big = "z" * 300_000
    rows = [(None, 0, "user", "a", ""), (None, 1, "assistant", None, ""), (0, 0, "user", "b", ""), (0, None, None, "c", "")]
    rows += [(7, 1, "user", big, ""), (7, 1, "user", big, ""), (2**53 + 1, 0, "system", "", "")]
    got = {r["conv_id"]: r for r in chat.format_chats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == {None, 0, 7, 2**53 + 1}
    assert parse(got[None]["text"]) == [("user", "a"), ("assistant", "")] and got[None]["cost"] == 0
    assert (got[0]["cost"], parse(got[0]["text"])) == (2, [("user", "b"), ("assistant", "c")])
    assert parse(got[7]["text"]) == [("user", big), ("assistant", big)] and got[7]["n_relabelled"] == 1
    # Relabelling a lone system turn costs less than two insertions.
    assert (got[2**53 + 1]["cost"], parse(got[2**53 + 1]["text"])) == (5, [("user", ""), ("assistant", "")])
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0
