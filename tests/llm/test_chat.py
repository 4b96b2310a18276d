"""Chat windows: exact round trip, loss mask and budget."""

import hashlib
import random

from pyspark.sql import functions as F

from hazeline.llm.chat import escaped, escaped_role, read_back, unescaped, windows

SCHEMA = "conv_id long, turn long, role string, text string, tokens string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def conversations(rng):
    bits = ["<|im_end|>", "<|im_start|>", "\\", "<", "|", "\n", "word ", "é ", "<\\|", "\\/", "assistant\n", ""]
    rows = []
    for c in range(1, 40):
        for t in range(rng.choice([1, 2, 5, 30])):
            role = "system" if t == 0 and rng.random() < 0.5 else rng.choice(["user", "assistant", "assistant", "a\nb", "<|x"])
            rows.append((c, t, role, "".join(rng.choice(bits) for _ in range(rng.choice([0, 3, 20, 60]))), None))
    rows += [(0, 0, "assistant", None, "x"), (50, None, None, "t", None), (50, 3, "assistant", "u", None),
             (50, 3, "assistant", "u", None), (None, 1, "assistant", "n", None), (60, 0, "assistant", "long " * 20_000, None)]
    return rows


def test_round_trip_and_loss(spark):
    rows = conversations(random.Random(4))
    shown = windows(spark.createDataFrame(rows, SCHEMA), budget=60, history=15)
    found = {r.conv_id: r for r in read_back(shown).collect()}
    by = {}
    for c, t, role, text, _ in rows:
        by.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert found.keys() == by.keys()
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, role, x in turns if role == "assistant")
        assert found[c].n_turns == len(turns)
        assert found[c].turns_sha256 == sha("".join(f"{r}\n{x}\n" for _, r, x in turns))
        assert (found[c].loss_chars, found[c].loss_sha256) == (len(loss), sha(loss))
    parts = shown.collect()
    assert sum(len(r.formatted) for r in parts if r.conv_id == 3) == found[3].formatted_chars
    assert any(r.own_from > 0 for r in parts)
    for r in parts:
        assert r.over_budget == (r.n_tokens > 60)
    assert read_back(windows(spark.createDataFrame([], SCHEMA))).count() == 0


def test_budget_system_turn_and_history(spark):
    rows = [(1, 0, "system", "s1 s2", None)] + [(1, t, "user" if t % 2 else "assistant", f"w{t} " * 4, None) for t in range(1, 60)]
    rows += [(1, 200, "user", "x " * 500, None)]
    parts = sorted(windows(spark.createDataFrame(rows, SCHEMA), budget=70, history=16).collect(), key=lambda r: r.window)
    assert len(parts) > 5
    assert all(r.formatted.startswith("<|im_start|>system\ns1 s2<|im_end|>\n") for r in parts)
    assert [r.over_budget for r in parts] == [False] * (len(parts) - 1) + [True]
    assert any(r.formatted[:r.own_from].count("<|im_start|>") > 1 for r in parts)


def test_escaping_is_reversible(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice("\\<|/\nan") for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    wrong = df.where((unescaped(escaped_role(F.col("t"))) != F.col("t")) | F.contains(escaped(F.col("t")), F.lit("<|"))
                     | F.contains(escaped_role(F.col("t")), F.lit("\n")))
    text_wrong = df.where(~F.contains(F.col("t"), F.lit("\n")) & (unescaped(escaped(F.col("t"))) != F.col("t")))
    assert wrong.count() == 0 and text_wrong.count() == 0
