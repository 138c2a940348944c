import random
import time

import duckdb
from pyspark.sql import functions as F

from equiscope.llm import chat
from equiscope.llm.chat import escape, format_chats, op5_chat, read_back, unescape

SCHEMA = "conv_id long, turn long, role string, text string"
MARKS = ["<s>", "</s>", "[INST] ", " [/INST]", " [INST+] ", "<<SYS>> ", " <</SYS>>", "[ANS] ", " [ANS+] ", "[ROLE]", "[TEXT] ", " [/ROLE]",
         " [ROLE+]", " [SYS+] ", "\\", "\\\\", "[", "<", "]", " ", "\n", "é", "x", "$1", "[\\INST]", "<\\</SYS>>", "<\\\\s>"]


def tricky(r):
    return "".join(r.choices(MARKS, k=r.randrange(8)))


def test_escape_is_reversible(spark):
    r = random.Random(1)
    df = spark.createDataFrame([(tricky(r),) for _ in range(2000)], "t string")
    out = df.select("t", escape(F.col("t")).alias("e")).withColumn("u", unescape(F.col("e")))
    assert out.filter("t <> u").count() == 0
    assert out.filter(F.col("e").rlike(chat.OWN) & ~F.col("e").rlike(r"\\")).count() == 0


def plain(rows):
    out = {}
    for c, turn, role, text in sorted(rows, key=lambda x: (str(x[0]), x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def test_read_back_and_loss(spark):
    r = random.Random(2)
    rows = [(c, t, r.choice(["user", "assistant", "assistant", "system", "tool", "", None, "[TEXT] "]), tricky(r)) for c in range(150) for t in range(r.randrange(1, 7))]
    rows += [(None, 1, "user", None), (500, None, "user", "first"), (500, 0, "user", "b"), (500, 0, "user", "a"), (500, 0, "user", "a"),
             (501, 0, "assistant", ""), (502, 0, "user", "w " * 40000)]
    out = format_chats(spark.createDataFrame(rows, SCHEMA).withColumns({"formatted": F.lit(1), "rows": F.lit(2), "loss": F.lit(3)}))
    learned = F.transform("loss", lambda s: unescape(F.substring("formatted", s["start"] + 1, s["length"])))
    by_blocks = out.filter(F.transform(chat.under_mask("formatted", "loss"), unescape) != learned)
    assert by_blocks.count() == 0
    expected = plain(rows)
    got = out.select("conv_id", read_back(F.col("formatted")).alias("turns"), learned.alias("learned"), "formatted").collect()
    assert len(got) == len(expected)
    for g in got:
        assert [tuple(t) for t in g.turns] == expected[g.conv_id], g
        assert g.learned == [t for role, t in expected[g.conv_id] if role == "assistant"]


def test_merging(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "user", "b"), (1, 3, "assistant", "c"), (1, 4, "assistant", "d"), (1, 5, "tool", "e"), (1, 6, "tool", "f")]
    text = format_chats(spark.createDataFrame(rows, SCHEMA)).first().formatted
    assert text == ("<s><<SYS>> s <</SYS>>[INST] a [INST+] b [/INST][ANS] c [ANS+] d </s>"
                    "[ROLE]tool[TEXT] e [ROLE+]tool[TEXT] f [/ROLE]")  # fmt: skip
    assert format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_conversation(spark):
    df = spark.range(3000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 5 < 3, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), "id").alias("text"))
    got = format_chats(df).select(read_back(F.col("formatted")).alias("t"), F.size("loss").alias("n")).first()
    assert [t.text for t in got.t] == [f"t{i}" for i in range(3000)] and got.n == 1200


def test_spans_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(chat, "SPAN_BLOCK", 4)
    rows = [(1, t, "assistant" if t % 3 else "user", "é" * (t % 14)) for t in range(60)]
    out = format_chats(spark.createDataFrame(rows, SCHEMA))
    got = out.select(chat.under_mask("formatted", "loss").alias("t")).first().t
    assert got == [text for _, t, _, text in rows if t % 3]


def test_turns_cost_alike(spark):
    """Twice the turns of one conversation take about twice the time."""

    def seconds(n):
        role = F.when(F.col("id") % 5 < 3, "user").otherwise("assistant")
        df = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.concat(F.lit("some words "), "id").alias("text"))
        began = time.perf_counter()
        row = format_chats(df).select(F.size(read_back(F.col("formatted"))).alias("n"), F.size(chat.under_mask("formatted", "loss")).alias("m")).first()
        assert row.n == n and row.m == n // 5 * 2
        return time.perf_counter() - began

    seconds(4000)
    assert min(seconds(40000) for _ in range(2)) < 4 * min(seconds(20000) for _ in range(2))


def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    cols = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    expected = con.execute(f"SELECT {', '.join(cols)} FROM ({chat.ORACLE_SQL}) ORDER BY 1").fetchall()
    assert [tuple(r) for r in op5_chat(spark, sf).select(*cols).orderBy("conv_id").collect()] == expected


def test_no_python_in_the_plan(spark, sf):
    plan = op5_chat(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
