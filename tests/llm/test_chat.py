"""Chat windows: round trip, budget, history and mask."""

import hashlib
import random

from pyspark.sql import functions as F

from cohortlens.llm.chat import chat_digest, format_chats, read_back

HOSTILE = ["<|im_end|>", "\\", "<\\|", "<|", "|>", "\\\\|x", "<|im_sep|>\n", "plain words", "é😀", "$1 \\1", ""]


def _turns(rng):
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 30)):
            role = "system" if turn == 0 and conv % 3 == 0 else ("user", "assistant")[turn % 2]
            text = " ".join(rng.choices(HOSTILE, k=rng.randint(0, 60)))
            rows.append((conv, turn, role, text, "w"))
    rows += [(50, t, ("user", "assistant")[t % 2], "word " * 9, "w") for t in range(900)]
    rows += [(51, 0, "assistant", "long " * 30_000, "w"), (51, 1, "assistant", None, "w")]
    rows += [(52, None, None, "a", "w"), (52, 3, "assistant", "tie", "w"), (52, 3, "assistant", "tie", "w")]
    rows += [(None, 1, "us|er\n<|", "b", "w"), (None, 2, "assistant", "c", "w")]
    rows += [(53, 0, "system", "s" * 9_000, "w"), (53, 1, "user", "q", "w"), (53, 2, "assistant", "a", "w")]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, window string"


def _ordered(rows):
    by = {}
    for conv, turn, role, text, _ in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in by.items()}


def test_round_trip(frame):
    rows = _turns(random.Random(3))
    out = format_chats(frame(rows, SCHEMA), budget=300, history=80).cache()
    want = _ordered(rows)
    got = {}
    for r in read_back(out).orderBy("conv_id", "window").collect():
        got.setdefault(r.conv_id, ([], []))
        got[r.conv_id][0].extend((t.role, t.text) for t in r.turns)
        got[r.conv_id][1].extend(r.learned)
    assert {c: t for c, (t, _) in got.items()} == want
    assert {c: l for c, (_, l) in got.items()} == {
        c: [t for role, t in v if role == "assistant"] for c, v in want.items()
    }
    digest = {r.conv_id: r for r in chat_digest(out).collect()}
    for conv, turns in want.items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns).encode()
        assert digest[conv].turns_sha256 == hashlib.sha256(said).hexdigest()
        assert digest[conv].loss_chars == sum(len(t) for r, t in turns if r == "assistant")


def test_budget_and_context(frame):
    out = format_chats(frame(_turns(random.Random(3)), SCHEMA), budget=300, history=80)
    for r in out.where("conv_id = 50").collect():
        # a turn takes 21 or 22 tokens
        assert r.text.count("<|im_end|>") * 21 <= 300
        assert r.n_context == (0 if r.window == 0 else 3)
        for s in r.loss:
            assert r.text[s.start : s.end] == "word " * 9
    first = {}
    for r in out.where("conv_id % 3 = 0").orderBy("window").collect():
        if r.text.startswith("<|im_start|>system"):
            head = r.text.split("<|im_end|>")[0]
            assert first.setdefault(r.conv_id, head) == head


def test_empty(frame):
    assert chat_digest(format_chats(frame([], SCHEMA))).collect() == []


def test_long_conversation_is_cut(frame):
    out = format_chats(frame(_turns(random.Random(3)), SCHEMA), budget=300, history=80)
    assert out.where("conv_id = 50").agg(F.max(F.length("text"))).first()[0] < 300 * 5
