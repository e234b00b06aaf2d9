import duckdb

from courtline.llm import chat
from courtline.llm.common import table
from llm_util import collected

SF = "/root/testdata/sf0.01"


def test_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS FROM '{SF}/conversations.parquet'")
    want = con.sql(chat.ORACLE).df().to_dict("records")
    got = collected(chat.rotate(table(spark, SF, "conversations")))
    key = lambda r: (r["conv_id"], r["participant"], r["part"])
    assert sorted(got, key=key) == sorted(want, key=key)


def test_masks_are_the_assistants_turns(spark):
    for r in chat.rotate(table(spark, "/root/testdata/sf0.001", "conversations")).collect():
        spans = [tuple(map(int, s.split(":"))) for s in r["mask"].split(",") if s]
        assert len(spans) == r["n_trained"]
        for a, b in spans:
            assert r["text"][:a].endswith(chat.ASSISTANT) and r["text"][:b].endswith(chat.END)
        assert r["text"].count(chat.ASSISTANT) >= len(spans)


def test_odd_rows(spark):
    rows = [
        (1, 0, "ann", "hi"), (1, 0, "ann", "hi"), (1, 1, None, None), (1, 1, "bob", ""), (1, None, "ann", "late"),
        (None, 3, "ann", "no conversation"), (2, 200, "eve", "x" * 100_000), (2, 5, "eve", "<|end|>"),
    ]
    df = spark.createDataFrame([(*r, "clash", 3) for r in rows], "conv_id long, turn int, role string, text string, part string, n_turns int")
    got = {(r["conv_id"], r["participant"], r["part"]): r for r in chat.rotate(df).collect()}
    assert len(got) == 9
    assert got[1, "ann", 0]["n_turns"] == 3 and got[1, "ann", -1]["n_turns"] == 1
    assert "<|user name=unknown|>" in got[1, "ann", 0]["text"]
    assert got[2, "eve", 3]["n_turns"] == 1 and len(got[2, "eve", 3]["text"]) > 100_000
    assert (None, "ann", 0) in got
    assert chat.rotate(df.filter("false")).count() == 0


def test_no_python_in_the_plan(spark):
    plan = chat.rotate(table(spark, "/root/testdata/sf0.001", "conversations"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
