import pytest

from faresettle.llm import catalog, chat

SCHEMA = "conv_id long, turn long, role string, text string, size string, one string, block string"


def chats(spark, conversations):
    rows = [(c, t, role, text, "x", "y", "z") for c, turns in conversations for t, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, SCHEMA)


def slow(conversations):
    """Ids of maximal conversations, by comparing all pairs; of equal ones the smallest."""
    kept = []
    for c, turns in conversations:
        longer = any(other[: len(turns)] == turns and len(other) > len(turns) for _, other in conversations)
        equal = any(other == turns and i < c for i, other in conversations)
        if not longer and not equal:
            kept.append(c)
    return sorted(kept)


U, A, B = ("user", "hi"), ("assistant", "hello"), ("user", "bye")


def test_snapshots_collapse(spark):
    logs = [(1, [U]), (2, [U, A]), (3, [U, A, B]), (4, [U, A, B]), (5, [U, B]), (6, [A]), (7, [("user", None)]), (8, [("user", "")]), (9, [(None, "hi")])]
    out = {r["conv_id"]: r for r in chat.format_chats(chats(spark, logs)).collect()}
    assert sorted(out) == slow(logs) == [3, 5, 6, 7, 8, 9]
    assert out[3]["text"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n<|im_start|>user\nbye<|im_end|>\n"
    assert (out[3]["n_turns"], out[3]["n_same"], out[5]["n_same"]) == (3, 2, 1)


def test_many_random_logs(spark):
    import random

    rng = random.Random(3)
    logs = [(c, [rng.choice([U, A, B]) for _ in range(rng.randrange(1, 6))]) for c in range(200)]
    assert sorted(r["conv_id"] for r in chat.format_chats(chats(spark, logs)).collect()) == slow(logs)


@pytest.mark.parametrize("ranges", ["1", "40"])
def test_conversations_over_many_ranges_are_one_row_each(spark, ranges):
    turns = [("user", f"t{k:03}") for k in range(100)]
    logs = [(1, turns), (2, turns[:13]), (3, turns[:12] + [B]), (4, turns[1:])]
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = {r["conv_id"]: r for r in chat.format_chats(chats(spark, logs)).collect()}
    finally:
        spark.conf.set(key, before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(out) == [1, 3, 4]
    for c, turns in logs:
        if c in out:
            assert out[c]["text"] == "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for role, text in turns)
            assert (out[c]["part"], out[c]["n_turns"]) == (0, len(turns))


def test_turns_without_numbers_are_split(spark):
    """1,500 turns, all without a number and a third of them equal: one conversation, one row, several ranges."""
    rows = [(7, None, "user", "same" if k % 3 else f"t{k:05}") for k in range(1500)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = chat.numbered_turns(frame).collect()
        out = chat.format_chats(frame).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r["at"] for r in turns) == list(range(1500))
    assert max(sum(r["block"] == b for r in turns) for b in {r["block"] for r in turns}) < 1500
    texts = [r["text"] for r in sorted(turns, key=lambda r: r["at"])]
    assert texts == sorted(texts) and len(out) == 1
    assert out[0]["text"] == "".join(f"<|im_start|>user\n{t}<|im_end|>\n" for t in texts)


def test_order_ties_gaps_and_nulls(spark):
    rows = [(1, 5, "user", "b"), (1, 5, "user", "a"), (1, None, "system", "s"), (1, 900, "user", "z"), (1, 900, "user", "z"), (None, 0, "user", "only"), (None, 1, "user", "two")]
    out = {r["conv_id"]: r for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert out[1]["text"].split("<|im_end|>\n")[:-1] == [f"<|im_start|>{x}" for x in ("system\ns", "user\na", "user\nb", "user\nz", "user\nz")]
    assert out[None]["n_turns"] == 2


def test_no_rows(spark):
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(sf, capsys):
    chat.format_chats(sf("conversations")).explain("formatted")
    plan = capsys.readouterr().out
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_table_against_sql(spark, scale):
    from check_oracle import connect, difference

    directory = f"/root/testdata/sf{scale}"
    result = catalog.op9_chat(spark, directory).toPandas()
    assert difference(result, connect(directory).sql(catalog.CHAT_SQL).df()) is None
