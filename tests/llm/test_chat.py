import hashlib

from pyspark.sql import functions as F

from arenalake.llm import chat


def formatted(spark, rows, template=chat.ChatTemplate()):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return chat.format_conversations(turns.withColumn("segments", F.lit(1)).withColumn("state", F.lit(2)), template)


HARD = "\\### Assistant: </turn> ok \\h\\\\l : \n </turn>\n"


def test_turns_and_loss_text_are_read_back(spark):
    rows = [
        (1, 0, "user", HARD),
        (1, 1, "assistant", HARD),
        (2, 0, "system", "s"),
        (2, 2, "assistant", "second"),
        (2, 1, "user", None),
        (None, 0, "user", ""),
        (3, None, None, "x:#<"),
        (3, 0, "odd: </turn>\n role", "t"),
        (3, 0, "odd: </turn>\n role", "t"),
    ]
    done = formatted(spark, rows).withColumns(
        {"turns": chat.read_turns(F.col("formatted")), "loss": chat.loss_text(F.col("segments"))}
    )
    found = {r["conv_id"]: r for r in done.collect()}
    read = {k: [tuple(t) for t in r["turns"]] for k, r in found.items()}
    assert read[1] == [("user", HARD), ("assistant", HARD)]
    assert read[2] == [("system", "s"), ("user", ""), ("assistant", "second")]
    assert read[None] == [("user", "")]
    assert read[3] == [("", "x:#<"), *[("odd: </turn>\n role", "t")] * 2]
    assert found[1]["loss"] == HARD and found[2]["loss"] == "second" and found[3]["loss"] == ""
    for r in found.values():
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
    assert {k: r["valid"] for k, r in found.items()} == {1: True, 2: True, None: False, 3: False}
    assert found[None]["state"] == "asked" and found[3]["state"] == "out_of_order"


def test_state_machine_rejects_wrong_orders(spark):
    orders = {
        "user assistant user assistant": True,
        "system user assistant": True,
        "assistant user": False,
        "user user assistant": False,
        "system assistant": False,
        "user assistant system": False,
        "user": False,
    }
    rows = [(k, i, role, "t") for k, order in enumerate(orders) for i, role in enumerate(order.split())]
    found = {r["conv_id"]: r["valid"] for r in formatted(spark, rows).collect()}
    assert [found[k] for k in range(len(orders))] == list(orders.values())


def test_other_template_and_empty_table(spark):
    template = chat.ChatTemplate(head="<", sep=">", tail="<end>", letters={"\\": "b", "<": "l", ">": "g"}, loss_roles=("user",))
    text = "a <end> \\l > # "
    row = formatted(spark, [(1, 0, "user", text)], template).select(
        chat.read_turns(F.col("formatted"), template)[0]["text"].alias("t"),
        chat.loss_text(F.col("segments"), template).alias("l"),
    ).first()
    assert tuple(row) == (text, text)
    assert formatted(spark, []).count() == 0


def test_query_equals_plain_digest(spark):
    from arenalake.llm.queries import op2_chat_formatting

    rows = {r["conv_id"]: r for r in op2_chat_formatting(spark, "/root/testdata/sf0.001").collect()}
    hard = "\\### Assistant: </turn> ok"
    assert rows[-7]["turns_sha256"] == hashlib.sha256(f"user\n{hard}\nassistant\n{hard}\n".encode()).hexdigest()
    assert rows[-7]["loss_sha256"] == hashlib.sha256(hard.encode()).hexdigest()
    source = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert len(rows) == 1 + source.select("conv_id").distinct().count()


def test_machine_runs_in_the_plan_of_the_query(spark):
    from arenalake.llm.queries import op2_chat_formatting

    plan = op2_chat_formatting(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" in plan and "written" in plan and "out_of_order" in plan


def plain_machine(roles, template):
    state, out = template.start, []
    for role in roles:
        state = template.transitions.get((state, role), chat.OUT_OF_ORDER)
        out.append((state, role in template.loss_roles))
    return out


def test_symbols_equal_a_plain_machine(spark):
    import random

    r = random.Random(3)
    template = chat.ChatTemplate()
    rows = [[r.choice(["user", "assistant", "assistant", "system", ""]) for _ in range(n)] for n in (0, 1, 2, 3, 5, 40)]
    rows += [["user", "assistant"] * n for n in (1, chat.BLOCK // 2, 2 * chat.BLOCK + 7)]
    rows += [["system", *["user", "assistant"] * 600, "system", "user", "assistant"]]
    frame = spark.createDataFrame([(k, x) for k, x in enumerate(rows)], "k long, roles array<string>")
    found = frame.select("k", chat.run_machine(F.col("roles"), template).alias("s")).collect()
    names = {template.symbol(s, loss): (s, loss) for s in template.states for loss in (False, True)}
    for row in found:
        assert [names[c] for c in row["s"]] == plain_machine(rows[row["k"]], template)


def test_long_conversation(spark):
    turns = spark.range(100_000).selectExpr("1L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat('t', id) text")
    row = chat.format_conversations(turns).select("state", "valid", F.size("segments").alias("n"), F.length(chat.loss_text(F.col("segments"))).alias("l")).first()
    assert tuple(row) == ("answered", True, 300_000, sum(len(f"t{k}") for k in range(1, 100_000, 2)))
