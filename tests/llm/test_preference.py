import os

import duckdb
from pyspark.sql import functions as F

from incident_stream.llm import preference
from incident_stream.llm.oracle import SQL
from incident_stream.llm.queries import op6_preference
from tests.llm.conftest import SMALL, rows_of

TURNS = "conv_id bigint, turn bigint, role string, text string"


def chat(spark, rows):
    return preference.conversations_of(spark.createDataFrame(rows, TURNS))


def pairs(spark, chosen, rejected):
    kind = "array<struct<turn:bigint,role:string,text:string>>"
    df = spark.createDataFrame([(1, chosen, rejected)], f"pair_id bigint, chosen {kind}, rejected {kind}")
    return preference.preference_pairs(df).first()


def trained(row, side):
    return [row[side][m["start"] : m["end"]] for m in row[f"{side}_mask"]]


A = (0, "user", "hi")


def test_common_turns_are_the_prompt(spark):
    row = pairs(
        spark,
        [A, (1, "assistant", "one"), (2, "user", "more"), (3, "assistant", "two 😀é")],
        [A, (1, "assistant", "one"), (2, "user", "less"), (3, "assistant", "three")],
    )
    assert row["n_common"] == 2
    assert row["prompt"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\none<|im_end|>\n"
    assert trained(row, "chosen") == ["two 😀é<|im_end|>"]
    assert trained(row, "rejected") == ["three<|im_end|>"]
    assert row["chosen"].startswith("<|im_start|>user\nmore")


def test_ends(spark):
    same = pairs(spark, [A], [A])
    assert (same["n_common"], same["chosen"], same["rejected"], same["chosen_mask"]) == (1, "", "", [])
    shorter = pairs(spark, [A], [A, (1, "assistant", "x")])
    assert (shorter["n_common"], shorter["chosen"]) == (1, "")
    assert trained(shorter, "rejected") == ["x<|im_end|>"]
    none = pairs(spark, None, [A])
    assert (none["n_common"], none["prompt"], none["chosen"]) == (0, "", "")
    different = pairs(spark, [(0, "user", "hi")], [(0, "system", "hi")])
    assert different["n_common"] == 0


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, None, None), (None, 0, "user", "lost"), (1, 1, "assistant", "b"), (2, None, "user", "x")]
    found = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat(spark, rows).collect()}
    assert found == {1: [(0, "", ""), (1, "assistant", "b"), (1, "assistant", "b")], 2: [(None, "user", "x")]}


def swapped(spark, rows):
    found = preference.last_reply_swapped(chat(spark, rows)).collect()
    return {r["pair_id"]: [t["text"] for t in r["rejected"]] for r in found}


def test_swapped_replies(spark):
    rows = [
        (2, 0, "user", "q"), (2, 1, "assistant", "a2"), (2, 2, "user", "bye"),
        (3, 0, "user", "r"), (3, 1, "assistant", "a3"),
        (4, 0, "user", "no reply"), (5, 0, "assistant", "a5"), (8, 0, "assistant", "last"),
    ]
    assert swapped(spark, rows) == {2: ["q", "a3", "bye"], 3: ["r", "a5"], 5: ["last"], 8: ["a2"]}
    assert swapped(spark, rows[-1:]) == {8: ["last"]}


def test_every_conversation_with_a_reply_has_a_pair(spark):
    """Over many ranges, with empty replies, very long ones and gaps between the ids."""
    ids = [(i * i) % 9973 - 500 for i in range(400)]
    rows = [(i, 0, "user", "q") for i in ids] + [(i, 1, "assistant", f"a{i}") for i in sorted(set(ids)) if i % 7]
    rows += [(20_000, 0, "assistant", None), (20_001, 0, "assistant", "long " * 100_000)]
    known = sorted({i for i, _, role, _ in rows if role == "assistant"})
    replies = {i: text or "" for i, _, role, text in rows if role == "assistant"}
    found = swapped(spark, rows)
    assert {i: texts[-1] for i, texts in found.items()} == {
        i: replies[j] for i, j in zip(known, [*known[1:], known[0]], strict=True)
    }


def test_clashing_columns(spark):
    rows = [(1, 0, "assistant", "a"), (2, 0, "assistant", "b")]
    df = spark.createDataFrame(rows, TURNS)
    for name in ("turns", "part", "at", "next", "following", "pair_id"):
        df = df.withColumn(name, F.lit("x"))
    found = preference.preference_pairs(preference.last_reply_swapped(preference.conversations_of(df)))
    assert sorted((r["pair_id"], trained(r, "rejected")) for r in found.collect()) == [
        (1, ["b<|im_end|>"]), (2, ["a<|im_end|>"])
    ]


def test_empty(spark):
    assert rows_of(preference.preference_pairs(preference.last_reply_swapped(chat(spark, [])))) == []


def test_query_against_sql(spark):
    db = duckdb.connect()
    path = os.path.join(SMALL, "conversations.parquet")
    db.sql(f"create view conversations as from '{path}'")
    wanted = db.sql(SQL["op6_preference"])
    replies = "select count(distinct conv_id) from conversations where role = 'assistant'"
    assert len(wanted.fetchall()) == db.sql(replies).fetchall()[0][0]
    df = op6_preference(spark, SMALL)
    assert sorted(wanted.columns) == sorted(df.columns)
    assert sorted(rows_of(df.select(*wanted.columns))) == sorted(wanted.fetchall())
