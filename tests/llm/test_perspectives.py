import glob
import os

import duckdb

from marlstone.llm import perspectives, queries


def test_query_matches_sql(spark, sf):
    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    rows = con.execute(queries.oracle_sql()["op10_perspectives"])
    names = [d[0] for d in rows.description]
    got = queries.op10_perspectives(spark, sf)
    assert sorted(names) == sorted(got.columns)
    order = sorted(names)
    want = sorted(tuple(r[names.index(c)] for c in order) for r in rows.fetchall())
    assert sorted(tuple(r[c] for c in order) for r in got.collect()) == want


def test_native_plan(spark, sf):
    plan = queries.op10_perspectives(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_rotation(spark):
    turns = [(1, 0, "system", "Be kind."), (1, 1, "ann", "Hi"), (1, 2, "bob", "Yo"), (1, 3, "eve", ""), (1, 2500, "ann", None), (1, None, "bob", "first"), (1, -3000, "bob", "before"), (2, 0, "system", "alone"), (None, 0, None, "who"), (3, 1, "ann", "same"), (3, 1, "ann", "same")]
    df = spark.createDataFrame([(*t, "x", 7) for t in turns], "conv_id long, turn long, role string, text string, name string, start int")
    got = perspectives.rotate(df).collect()
    by = {}
    for r in got:
        by.setdefault((r.conv_id, r.perspective), []).append(r)
    assert set(by) == {(1, "ann"), (1, "bob"), (1, "eve"), (None, "unknown"), (3, "ann")}
    for (_, who), rows in by.items():
        rows.sort(key=lambda r: r.seq)
        text = "".join(r.rendered for r in rows)
        assert [r.seq for r in rows] == list(range(len(rows)))
        for r in rows:
            assert text[r.start : r.end] == r.rendered
            assert r.loss_mask == int(r.name == who) and (r.role == "assistant") == (r.name == who)
            assert "name=" not in r.rendered or r.role == "user"
    ann = sorted(by[1, "ann"], key=lambda r: r.seq)
    whole = "".join(r.rendered for r in ann)
    assert [whole[r.content_start : r.content_end] for r in ann] == ["first", "before", "Be kind.", "Hi", "Yo", "", ""]
    assert whole.startswith("<|im_start|>user name=bob\nfirst<|im_end|>\n<|im_start|>user name=bob\nbefore<|im_end|>\n<|im_start|>system\nBe kind.")
    assert perspectives.rotate(df.limit(0)).count() == 0
