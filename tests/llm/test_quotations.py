import duckdb

from landgrid.llm.quotations import ORACLE, chats, link_quotations, op9_quotations

ROWS = [
    (1, 0, "user", "Where is the well of section twelve?\nIt was drilled long ago."),
    (1, 1, "assistant", "> Where is the well of section twelve?\nIn the north-west quarter."),
    (1, 2, "user", "On Monday A wrote:\n>> Where is the WELL of section twelve?\n> In the north-west quarter.\nThanks, and who drilled it?"),
    (2, 0, "user", "> Thanks, and who   drilled it?\n\nA company from Tulsa did, I think."),
    (2, 1, "assistant", None),
    (2, 2, "user", "> never said by anyone at all\nok"),
    (3, 0, "user", "Where is the well of section twelve?\nIt was drilled long ago."),
    (3, 2, "user", "> ok\nshort lines do link when they are whole"),
    (4, 0, "system", ""),
    (4, 5, "user", ">only a quote of nothing here"),
    (5, 0, "user", "> It was drilled long ago.\nreally?"),
]


def test_links_and_threads(spark):
    df = spark.createDataFrame([(*r, 9) for r in ROWS], "conv_id long, turn long, role string, text string, depth int")
    out = {(r.conv_id, r.turn): r for r in link_quotations(df).collect()}
    assert len(out) == len(ROWS)
    assert out[1, 1].text == "In the north-west quarter." and (out[1, 1].reply_conv, out[1, 1].reply_turn) == (1, 0)
    assert out[1, 2].text == "Thanks, and who drilled it?" and out[1, 2].quote_depth == 2 and out[1, 2].n_quotes == 2
    assert (out[2, 0].reply_conv, out[2, 0].reply_turn) == (1, 2) and (out[2, 0].thread_conv, out[2, 0].depth) == (1, 3)
    assert (out[2, 1].thread_conv, out[2, 1].depth, out[2, 1].text) == (1, 4, "")
    assert (out[2, 2].reply_turn, out[2, 2].depth) == (1, 5)
    assert out[3, 0].reply_turn is None and out[3, 0].depth == 0
    assert (out[3, 2].reply_conv, out[3, 2].reply_turn) == (2, 2)
    assert (out[5, 0].reply_conv, out[5, 0].reply_turn) == (1, 0)
    assert out[4, 5].text == "" and out[4, 5].reply_turn is None
    parts = chats(link_quotations(df), 3).collect()
    assert sum(len(p.messages) for p in parts) == sum(bool(r.text) for r in out.values())


def test_oracle(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    con = duckdb.connect()
    con.register("conversations", df.toPandas())
    want = con.sql(ORACLE)
    got = link_quotations(df)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))


def test_oracle_on_table(spark):
    con = duckdb.connect()
    con.sql("create view conversations as select * from '/root/testdata/sf0.001/conversations.parquet'")
    want = con.sql(ORACLE)
    got = op9_quotations(spark, "/root/testdata/sf0.001").select(*want.columns).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want.fetchall()))


def test_nulls_repeats_and_none(spark):
    rows = [(None, 0, "user", "x"), (1, None, None, "y"), (7, 0, "user", "same"), (7, 0, "user", "same"), (7, 1, "user", "> same\nreply")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = link_quotations(df).collect()
    assert len(out) == 5 and sorted(r.depth for r in out) == [0, 0, 0, 0, 1]
    assert link_quotations(df.limit(0)).collect() == []


def test_conversations_are_whole_and_in_reply_order(spark, tmp_path):
    rows = [*ROWS, (None, 0, "user", "no conversation"), (None, 0, "user", "nor here"), (1, None, None, "no turn")]
    df = spark.createDataFrame(rows[::-1], "conv_id long, turn long, role string, text string")
    df.repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    out = op9_quotations(spark, str(tmp_path)).collect()
    keyed = [r for r in out if r.thread_conv is not None]
    order = [(r.thread_conv, r.thread_turn, r.depth, r.conv_id, r.turn) for r in keyed]
    assert len(out) == len(rows) and len(keyed) == len(ROWS) and order == sorted(order)
    parts = chats(spark.createDataFrame(out), 3).collect()
    assert sorted(m.text for p in parts if p.thread_conv is None for m in p.messages) == ["no conversation", "no turn", "nor here"]
    assert all(len(p.messages) == 1 for p in parts if p.thread_conv is None)
    whole = chats(spark.createDataFrame(out), 3, empty=True).collect()
    assert sum(len(p.messages) for p in whole) == len(rows)


def test_very_long_text_with_many_quotes(spark):
    text = "\n".join(("> " * (1 + i % 3)) + f"quoted line number {i}" if i % 7 else f"own line {i}" for i in range(20_000))
    df = spark.createDataFrame([(1, 0, "user", "quoted line number 1"), (1, 1, "user", text)], "conv_id long, turn long, role string, text string")
    out = {r.turn: r for r in link_quotations(df).collect()}
    assert out[1].n_quotes > 15_000 and out[1].quote_depth == 3 and out[1].reply_turn == 0


def test_broad_and_deep_threads_are_cut_into_parts(spark):
    rows = [(1, 0, "user", "the root of all the replies here")]
    rows += [(10 + i, 0, "user", f"> the root of all the replies here\nreply number {i}") for i in range(500)]
    rows += [(5000, i, "user", f"turn {i}") for i in range(300)]
    linked = link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    depth = {r.text: (r.thread_conv, r.depth) for r in linked.collect()}
    parts = chats(linked, 16).collect()
    assert max(len(p.messages) for p in parts) < 100 and sum(len(p.messages) for p in parts) == len(rows)
    by = {}
    for p in sorted(parts, key=lambda p: (p.thread_conv, p.part)):
        by.setdefault(p.thread_conv, []).extend(depth[m.text][1] for m in p.messages)
    assert all(d == sorted(d) for d in by.values())
