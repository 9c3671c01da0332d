"""Chat windows read back, and their budget, history and mask against a plain loop."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from barloom.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string"
ODD = ["\\### Assistant: </turn> ok", "#" * 7, "\\", "<\\/turn>", "</turn></turn>\n", "### user: x</turn>\n", "", None, "a\nb", "é🎉", "\\\\/", "<", "/turn>"]


def conversations(seed):
    random.seed(seed)
    out = []
    for conv in (0, 1, 2, None):
        for turn in range(random.choice([1, 5, 40])):
            role = "system" if turn == 0 and conv != 1 else random.choice(["user", "assistant", "sys:tem", None])
            text = random.choice(ODD) if random.random() < 0.5 else "w" * random.randrange(120)
            out.append((conv, turn, role, text))
    return out + [(5, None, "user", "first"), (5, 2, "user", "b"), (5, 2, "assistant", "a"), (5, 2, "assistant", "a"), (6, 1, "system", "s" * 400), (6, 2, "assistant", "t")]


def tokens(text):
    return -(-len(text) // 4) + 4


def plain_windows(rows, budget, history, reserve):
    """conversation -> list of (repeated turns, new turns)."""
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn, role or "", text or ""))
    step = budget - history - reserve
    out = {}
    for conv, turns in talks.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, t[2], t[3]))
        at, placed = 0, []
        for _, _, role, text in turns:
            placed.append((at, at + tokens(text), role, text))
            at = placed[-1][1]
        windows = defaultdict(list)
        for t in placed:
            windows[2 * (t[0] // step) + ((t[1] - 1) // step != t[0] // step)].append(t)
        system = next((t for t in placed if t[2] == "system"), None)
        laid = []
        for _, new in sorted(windows.items()):
            start = new[0][0]
            again = [t for t in placed if t[0] >= start - history and t[1] <= start]
            if system and system[1] <= start and system not in again:
                again = [system, *again]
            laid.append((again, new))
        out[conv] = laid
    return out


@pytest.mark.parametrize("seed, budget, history, reserve", [(1, 100, 20, 20), (2, 60, 0, 10), (3, 1024, 128, 128)])
def test_windows_are_those_of_the_plain_loop(spark, monkeypatch, seed, budget, history, reserve):
    monkeypatch.setattr(chat, "BLOCK", 8)
    rows = conversations(seed)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("window", F.lit("clash")).withColumn("begin", F.lit(1))
    windows = chat.format_windows(df, budget=budget, history=history, system_reserve=reserve)
    got = defaultdict(list)
    for r in windows.orderBy("conv_id", "window").collect():
        got[r["conv_id"]].append(r)
    want = plain_windows(rows, budget, history, reserve)
    assert set(got) == set(want)
    for conv, laid in want.items():
        assert len(got[conv]) == len(laid)
        for row, (again, new) in zip(got[conv], laid):
            assert row["n_repeated"] == len(again)
            assert row["n_tokens"] == sum(t[1] - t[0] for t in again + new)
            assert row["over_budget"] == (row["n_tokens"] > budget)
            assert row["text"].count(chat.CLOSE) == len(again) + len(new)
            assert "###" not in row["text"].replace("\n### ", "").removeprefix("### ")
    read = {(r["conv_id"], r["window"]): r for r in chat.read_turns(windows).collect()}
    for conv, laid in want.items():
        for row, (_, new) in zip(got[conv], laid):
            back = read[(conv, row["window"])]
            assert [(t["role"], t["text"]) for t in back["turns"]] == [(t[2], t[3]) for t in new]
            assert back["targets"] == [t[3] for t in new if t[2] == "assistant"]


def test_long_roles_read_back(spark):
    roles = ["r" * 1_000_000, ":" * 300_000, "\\:" * 300_000, "%1:%0:" * 100_000, "## </turn>\n: " * 50_000, "%", "%1", ":", ": ", ""]
    rows = [(n, 0, role, "said: " + ODD[0]) for n, role in enumerate(roles)]
    windows = chat.format_windows(spark.createDataFrame(rows, SCHEMA))
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat.read_turns(windows).collect()}
    assert got == {n: [(role, text)] for n, _, role, text in rows}


def test_query_has_conversations_without_id(spark, tmp_path):
    rows = conversations(1) + [(None, 3, "r" * 5_000, "x"), (3, 1, "assistant", "y")]
    odd = spark.createDataFrame(rows, SCHEMA).withColumn("window", F.lit("clash")).withColumn("more", F.lit(1))
    odd.write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in queries.op5_chat_format(spark, str(tmp_path)).collect()}
    want = plain_windows([*rows, (-7, 0, "user", ODD[0]), (-7, 1, "assistant", ODD[0])], chat.BUDGET, chat.HISTORY, chat.SYSTEM_RESERVE)
    assert set(got) == set(want) and None in got
    for conv, laid in want.items():
        turns = [t for _, new in laid for t in new]
        said = "".join(t[3] for t in turns if t[2] == "assistant")
        assert (got[conv]["n_turns"], got[conv]["loss_chars"]) == (len(turns), len(said))
        assert got[conv]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_no_conversations(spark):
    assert chat.format_windows(spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_has_no_python(spark):
    plan = chat.format_windows(spark.range(3).select(F.col("id").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.lit("x").alias("text")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_reads_every_conversation_back(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = {r["conv_id"]: r for r in queries.op5_chat_format(spark, sf_dir).collect()}
    talks = defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        talks[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    talks[-7] = [(0, "user", ODD[0]), (1, "assistant", ODD[0])]
    assert set(got) == set(talks)
    for conv, turns in talks.items():
        turns.sort()
        said = "".join(t for _, role, t in turns if role == "assistant")
        row = got[conv]
        assert (row["n_turns"], row["loss_chars"]) == (len(turns), len(said))
        assert row["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
