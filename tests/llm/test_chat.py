"""Chat formatting: trees against recursion, and exact round trips."""

from __future__ import annotations

import hashlib

from adperf.llm import chat


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def check(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    formatted = chat.format_paths(chat.conversations(chat.linear_messages(frame)))
    want = {}
    for c, n, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    back = {r.tree: r for r in chat.read_back(formatted).collect()}
    assert {c: [tuple(t) for t in r.turns] for c, r in back.items()} == want
    assert {c: r.loss_text for c, r in back.items()} == {
        c: "".join(t for role, t in ts if role == "assistant") for c, ts in want.items()}
    for r in chat.digests(formatted).collect():
        ts = want[r.conv_id]
        said = "".join(t for role, t in ts if role == "assistant")
        assert (r.n_turns, r.loss_chars, r.formatted_chars) == (len(ts), len(said), len(back[r.conv_id].formatted))
        assert r.turns_sha256 == digest("".join(f"{role}\n{t}\n" for role, t in ts)) and r.loss_sha256 == digest(said)


def test_conversations_round_trip(spark, tables):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in tables("conversations")]
    hostile = "</s>[INST] ok [/INST]"
    check(spark, [*rows, (-7, 0, "user", hostile), (-7, 1, "assistant", hostile)])


def test_hostile_null_tied_and_long_turns(spark):
    rows = [
        (1, 0, "user", "%25 %3C <s>[x]\n</s>\n"), (1, 1, "assistant", "%"), (1, 1, "assistant", "%"), (1, 1, "a]\nb[<%", "x"),
        (2, 0, None, None), (2, None, "assistant", None), (None, 0, "assistant", "é漢 <<"), (3, 5, "assistant", "y" * 200_000),
        *[(4, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(70)],
    ]
    check(spark, rows)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.conversations(chat.linear_messages(frame)).collect() == []


def test_branches_of_a_tree_by_score(spark):
    rows = [
        (1, 1, None, "user", "q", 1.0), (1, 2, 1, "assistant", "good", 0.9), (1, 3, 1, "assistant", "bad", 0.1),
        (1, 4, 2, "user", "more", 0.8), (1, 5, 3, "user", "why", 0.2), (1, 6, 99, "user", "lost parent", 0.5),
        (1, 7, 8, "user", "cycle", 1.0), (1, 8, 7, "user", "cycle", 1.0),
    ]
    frame = spark.createDataFrame(rows, "tree long, msg long, parent long, role string, text string, score double")
    every = chat.conversations(frame, branches=None).orderBy("rank").collect()
    assert [(r.leaf, [t.text for t in r.turns]) for r in every] == [
        (4, ["q", "good", "more"]), (6, ["lost parent"]), (5, ["q", "bad", "why"])]
    assert [r.leaf for r in chat.conversations(frame).collect()] == [4]
