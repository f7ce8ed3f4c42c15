"""Windows, escapes and loss masks of chat formatting."""

import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelspark.llm import chat_windows as C

PIECES = st.lists(st.sampled_from([*C.CONTROLS, C.JOINER, "<", "|", "[", "/", "s", ">", "x ", "\n"]), max_size=12)


@given(PIECES)
def test_escape_is_reversible_and_leaves_no_control(parts):
    text = "".join(parts)
    shown = C.escape(text)
    assert C.unescape(shown) == text
    assert not any(c in shown for c in C.CONTROLS)


def rows():
    out = [(1, 0, "system", "be good"), (2, 0, "user", None), (2, 1, None, ""), (3, 5, "assistant", "alone"),
           (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
           (None, 0, "user", "no id"), (4, 1, "assistant", "tie b"), (4, 1, "assistant", "tie a"), (4, 1, "assistant", "tie a"),
           (4, None, "system", "first"), (5, 0, "user", "w " * 90), (5, 1, "assistant", "very long " * 200)]
    out += [(1, i, ("user", "assistant")[i % 2], f"turn {i} " + "w " * (i * 7 % 23)) for i in range(1, 60)]
    return out


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame([(*r, "x") for r in rows()], "conv_id long, turn long, role string, text string, window string")


def expected():
    by = {}
    for conv, turn, role, text in rows():
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {k: [(r, t) for _, _, r, t in sorted(v)] for k, v in by.items()}


def test_digests_are_those_of_the_turns(spark, turns):
    got = {r.conv_id: r for r in C.digest_windows(C.format_conversations(turns, budget=60, history=25)).collect()}
    want = expected()
    assert set(got) == set(want)
    for conv, parts in want.items():
        r, target = got[conv], "".join(t for role, t in parts if role == "assistant")
        assert r.n_turns == len(parts)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in parts).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(target), hashlib.sha256(target.encode()).hexdigest())


def test_windows_keep_the_budget_and_the_system_turn(spark, turns):
    windows = C.format_conversations(turns, budget=60, history=25).collect()
    assert sum(w.conv_id == 1 for w in windows) > 5
    assert sum(w.n_repeated > 0 for w in windows) > 3
    for w in windows:
        parts = list(C.parse(w.text))
        assert w.tokens == sum(C.turn_tokens(r, t) for r, t, _, _ in parts)
        assert w.over_budget == (w.tokens > 60)
        if w.over_budget:
            assert len(parts) == 1 + w.has_system
        if w.conv_id == 1:
            assert parts[0][:2] == ("system", "be good")
        repeated = parts[w.has_system : w.has_system + w.n_repeated]
        assert sum(C.turn_tokens(r, t) for r, t, _, _ in repeated) <= 25
        fresh = parts[w.has_system + w.n_repeated :]
        assert [(s, e) for r, _, s, e in fresh if r == "assistant"] == [(x.start, x.end) for x in w.loss]


def test_empty_table(turns):
    assert C.digest_windows(C.format_conversations(turns.limit(0))).count() == 0


def test_registered_query(spark):
    from panelspark.llm.catalog import op5_chat_windows

    root = "/root/testdata/sf0.01"
    got = op5_chat_windows(spark, root).cache()
    want = spark.read.parquet(f"{root}/conversations.parquet").groupBy("conv_id").agg(
        F.count("*").alias("n"),
        F.sum(F.when(F.col("role") == "assistant", F.length(F.coalesce("text", F.lit("")))).otherwise(0)).alias("c"),
    )
    assert got.count() == want.count() + 1
    assert got.join(want, "conv_id").where("n <> n_turns or c <> loss_chars").count() == 0
