import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import chat

LOG = "conv_id long, seq long, kind string, message string, role string, text string"
RANK = {k: i for i, k in enumerate(chat.KINDS)}


def folded(events):
    """The final messages of one conversation, event by event."""
    first = lambda x: (x is not None, x if x is not None else 0)
    text = lambda x: (x is not None, x or "")
    events = sorted((e for e in events if e[2] in RANK), key=lambda e: (first(e[1]), RANK[e[2]], text(e[3]), text(e[4]), text(e[5])))
    log = []  # [began, message, role, text]
    for at, (_, _, kind, message, role, words) in enumerate(events):
        own = [m for m in log if m["message"] == message]
        if kind == "append" or kind == "delta" and not own:
            log.append({"at": at, "message": message, "role": role or "", "text": words or "", "gone": False})
        elif own and kind == "delta":
            own[-1]["text"] += words or ""
        elif own and kind == "edit":
            own[-1]["text"] = words or ""
        elif own:
            own[-1]["text"] = ""
            for m in log:
                m["gone"] |= m["at"] > own[-1]["at"]
    return [(m["role"], m["text"]) for m in log if not m["gone"]]


@pytest.mark.parametrize("seed", range(3))
def test_reconstruct_as_event_by_event(spark, seed):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(60), None]:
        for _ in range(rng.randint(1, 25)):
            rows.append((conv, rng.choice([*range(30), None]), rng.choice([*chat.KINDS, "delta", "delta", "other", None]), rng.choice(["m1", "m2", "m3", None]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b ", "", None, "</s>"])))
    log = spark.createDataFrame(rows, LOG).withColumn("began", F.lit("clash")).withColumn("pos", F.lit("clash"))
    got = {}
    for r in sorted(chat.reconstruct(log).collect(), key=lambda r: r["at"]):
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    convs = {r[0] for r in rows}
    assert {c: got.get(c, []) for c in convs} == {c: folded([r for r in rows if r[0] == c]) for c in convs}


def test_texts_come_back_and_hold_no_control_string(spark):
    rng = random.Random(2)
    bits = [*chat.CONTROLS, "\\", "<", ">", "|", "[", "]", "/", "s", "INST", "SYS", "$1", " ", "\n", "é🙂"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(1500)]
    texts += [None, "", "</s>[INST] ok [/INST]", "x" * 1_000_000 + "<|im_end|>"]
    rows = [(i // 4, i % 4, rng.choice(["user", "assistant", "system", None, "<|im_sep|>"]), t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    rendered = chat.render(chat.reconstruct(chat.as_log(df))).select("*", chat.parse(F.col("formatted")).alias("turns"), chat.escaped(F.lit("a")).alias("x"))
    for r in rendered.collect():
        own = [(role or "", text or "") for c, _, role, text in rows if c == r["conv_id"]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == own
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        inside = r["formatted"].replace(chat.START, "").replace(chat.SEP, "").replace(chat.END, "")
        assert r["formatted"].count(chat.END) == r["formatted"].count(chat.START) == len(own)
        marked = [s["text"] for s in r["segments"] if s["loss"]]
        assert len(marked) == sum(role == "assistant" for role, _ in own)
        assert not any(c in text for c in chat.CONTROLS for text in marked) and inside is not None


def test_digests_ties_and_nulls(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (None, None, None, None), (2, 5, "user", "only")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.digests(chat.render(chat.reconstruct(chat.as_log(df)))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1]["n_turns"], got[1]["loss_chars"], got[1]["loss_sha256"]) == (4, 3, sha("aab"))
    assert got[1]["turns_sha256"] == sha("user\n\nassistant\na\nassistant\na\nassistant\nb\n")
    assert (got[2]["n_turns"], got[2]["loss_chars"], got[2]["loss_sha256"]) == (1, 0, sha(""))
    assert got[None]["turns_sha256"] == sha("\n\n")


def test_empty_log_and_native_plan(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    df = chat.digests(chat.render(chat.reconstruct(chat.as_log(none))))
    assert df.collect() == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow")) and plan.count("Exchange hashpartitioning") == 1
