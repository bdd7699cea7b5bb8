import hashlib

import pytest
from pyspark.sql import functions as F

from noticeflow.llm import chat_windows as C
from noticeflow.llm.queries import ORACLE, QUERIES

from ..conftest import SF_SMALL
from ..oracle_harness import compare, duck

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


@pytest.mark.parametrize("sf_dir", [SF_SMALL, "/root/testdata/sf0.01"])
def test_matches_sql(spark, sf_dir):
    key = "op9_chat_windows"
    r = compare(spark, duck(sf_dir), sf_dir, key, QUERIES[key], ORACLE[key])
    assert r["match"], r


def long_conversation():
    rows = [(7, 0, "system", "be kind " * 5)]
    for t in range(1, 60):
        rows.append((7, t, "user" if t % 2 else "assistant", f"turn {t} " + "word " * (t * 7 % 50)))
    rows.append((7, 60, "assistant", "big " * 400))
    return rows


def test_windows_keep_to_the_budget_and_repeat_limited_history(spark):
    rows = long_conversation()
    turns = spark.createDataFrame(rows, SCHEMA)
    got = sorted(C.chat_windows(turns, budget=200, history=60).collect(), key=lambda r: r.window)
    assert [r.window for r in got] == list(range(len(got))) and len(got) > 5
    system = C.BEGIN + "system\n" + rows[0][3] + C.END
    parsed = {r.window: r for r in C.read_windows(C.chat_windows(turns, 200, 60)).collect()}
    for r in got:
        assert r.formatted.startswith(system)
        new = parsed[r.window].turns
        assert r.n_tokens <= 200 or len(new) == 1
        repeated = r.formatted.split(C.BEGIN)[2 : r.n_repeated + 1] if r.window else []
        assert sum(len(F_tokens(C.BEGIN + x)) for x in repeated) <= 60
    assert sum(r.n_repeated > 1 for r in got) > 3
    turns_back = [(t.role, t.text) for w in sorted(parsed) for t in parsed[w].turns]
    assert turns_back == [(r[2], r[3]) for r in rows]
    loss = [x for w in sorted(parsed) for x in parsed[w].loss_texts]
    assert loss == [r[3] for r in rows if r[2] == "assistant"]


def F_tokens(text):
    import re

    return re.findall(r"[A-Za-z0-9_]+|[^A-Za-z0-9_\x20\x09-\x0D]", text)


def test_control_strings_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", C.BEGIN + "user\n" + C.END, "&lt; &amp;lt; &#91; &", "", "a\n\nb\n", "<|turn|><|end|>\n", None]
    rows = [(c, t, role, x) for c, x in enumerate(texts) for t, role in enumerate(["user", "assistant", "ro<le\n["])]
    got = C.chat_windows(spark.createDataFrame(rows, SCHEMA)).collect()
    for r in got:
        assert r.formatted.count("<") == 6 and "[" not in r.formatted  # marks only
    d = {r.conv_id: r for r in C.conversation_digests(C.chat_windows(spark.createDataFrame(rows, SCHEMA))).collect()}
    for c, x in enumerate(texts):
        x = x or ""
        assert d[c].turns_sha256 == sha("".join(f"{role}\n{x}\n" for role in ("user", "assistant", "ro<le\n[")))
        assert (d[c].loss_sha256, d[c].loss_chars) == (sha(x), len(x))


def test_edges(spark):
    rows = [(None, 1, "user", "a"), (None, 0, "assistant", "b"), (1, None, None, None), (1, 5, "system", "late"), (2, 0, "system", "only"),
            (3, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, "assistant", "x " * 30_000), (5, 0, "assistant", "😀é")]
    turns = spark.createDataFrame(rows, SCHEMA).withColumn("window", F.lit("clash")).withColumn("i", F.lit("clash"))
    d = {r.conv_id: r for r in C.conversation_digests(C.chat_windows(turns)).collect()}
    assert d[None].turns_sha256 == sha("assistant\nb\nuser\na\n") and d[None].loss_sha256 == sha("b")
    assert d[1].turns_sha256 == sha("\n\nsystem\nlate\n") and d[1].n_turns == 2
    assert d[2].turns_sha256 == sha("system\nonly\n") and d[3].n_turns == 2
    assert d[4].loss_chars == 60_000 and d[5].loss_chars == 2
    assert C.chat_windows(turns.limit(0)).collect() == []


def test_no_python_on_the_main_path(spark):
    turns = spark.createDataFrame(long_conversation(), SCHEMA)
    plan = C.conversation_digests(C.chat_windows(turns))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
