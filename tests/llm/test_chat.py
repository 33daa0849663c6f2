import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tarnwork.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    """Turns per conversation in order: role and text."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv].append(((turn is not None, turn or 0), (role is not None, role or ""), (text or "").encode(), role, text or ""))
    return {c: [(r[3], r[4]) for r in sorted(v, key=lambda r: r[:3])] for c, v in out.items()}


def read(windows):
    out = defaultdict(list)
    for w in sorted(windows, key=lambda w: w.window_no):
        out[w.conv_id] += [(t.role, t.text) for t in w.turns]
    return out


def lost(windows):
    out = defaultdict(list)
    for w in sorted(windows, key=lambda w: w.window_no):
        out[w.conv_id] += [w.formatted[m.start : m.end] for m in w.loss]
    return out


def made(seed, n):
    rng, rows = random.Random(seed), []
    parts = [*chat.CONTROL, "\\", "<", "|im_end|>", "word ", "é", "\n", "<\\/s>", "[", "😀"]
    for conv in range(n):
        turns = rng.randint(1, 30)
        for turn in range(turns):
            role = "system" if turn == 0 and rng.random() < 0.5 else rng.choice(["user", "assistant", "tool"])
            rows.append((conv, turn * 3, role, "".join(rng.choice(parts) for _ in range(rng.choice([0, 3, 30, 200])))))
    return rows


@pytest.mark.parametrize("budget, history", [(2048, 512), (200, 60), (80, 0)])
def test_everything_comes_back(frame, budget, history):
    rows = made(budget, 25)
    windows = chat.read_chats(chat.format_chats(frame(rows, SCHEMA), budget=budget, history=history)).collect()
    wanted = ordered(rows)
    assert read(windows) == wanted
    spoken = {c: [t for r, t in turns if r == "assistant"] for c, turns in wanted.items()}
    texts = lost(windows)
    assert {c: len(v) for c, v in texts.items()} == {c: len(v) for c, v in spoken.items()}
    for w in windows:
        assert w.tokens <= budget or w.over_budget
        new = w.n_turns - w.n_repeated
        assert not w.over_budget or new == 1 or w.has_system
        assert not w.has_system or w.formatted.startswith("<|im_start|>system\n")
        for c in chat.CONTROL:
            plain = w.formatted.replace("<|im_start|>", "", w.formatted.count("<|im_start|>")) if c != "<|im_start|>" else ""
            assert c == "<|im_end|>" or c not in plain
        assert w.formatted.count("<|im_end|>") == w.formatted.count("<|im_start|>") == w.n_turns + w.has_system
    if history:
        assert any(w.n_repeated for w in windows)


def test_history_is_what_precedes(frame):
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i} " + "x " * 20) for i in range(60)]
    windows = chat.format_chats(frame(rows, SCHEMA), budget=200, history=60)
    parts = [[p.split("\n", 1)[1].split()[1] for p in w.formatted.split("<|im_start|>")[1:]] for w in sorted(windows.collect(), key=lambda w: w.window_no)]
    for number, part in enumerate(parts):
        numbers = [int(p) for p in part]
        assert numbers == list(range(numbers[0], numbers[-1] + 1))
        assert number == 0 or numbers[0] == int(parts[number - 1][-1])  # two turns do not fit into the history, one does


def test_escape_is_reversible(spark):
    rng = random.Random(8)
    alphabet = ["<", "[", "\\", "|im_end|>", "/s>", "s>", "INST]", "<SYS>>", "x", "</SYS>>"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e")).withColumn("u", chat.unescaped(F.col("e")))
    for r in df.collect():
        assert r.u == r.t and not any(c in r.e for c in chat.CONTROL)


def test_odd_rows(frame):
    rows = [
        (None, 0, "system", "s"), (None, 1, None, None), (None, None, "assistant", "before"), (1, 0, "system", "only"), (2, 0, "", "empty role"), (2, 1, "odd\nrole", "a"),
        (2, 1, "odd\nrole", "a"), (2, 1, "assistant", None), (3, 5, "assistant", "x " * 30_000), (3, 6, "user", ""), (4, 0, "system", "long " * 4000), (4, 1, "assistant", "b"), (4, 2, "system", "late"),
    ]
    df = frame([(*r, "z", 1) for r in rows], SCHEMA + ", formatted string, span int")
    windows = chat.read_chats(chat.format_chats(df)).collect()
    assert read(windows) == ordered(rows)
    assert {w.conv_id for w in windows if w.over_budget} == {3, 4}
    assert chat.format_chats(frame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        chat.format_chats(df, budget=100, history=90)


def test_all_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    found = {r.conv_id: r for r in chat.op3_chat_formatting(spark, sf_dir).collect()}
    wanted = ordered(rows)
    assert set(found) == set(wanted)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for conv, turns in wanted.items():
        r, spoken = found[conv], "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), digest("".join(f"{role}\n{t}\n" for role, t in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(spoken), digest(spoken)) and r.formatted_chars >= sum(len(t) for _, t in turns)
