import zlib
from collections import Counter, defaultdict

import pytest

from faresettle.llm import shards


def check_law(rows, out, count=8):
    assert sorted((r["doc_id"] is not None, r["doc_id"]) for r in out if r["doc_id"] is not None) == sorted((True, i) for i, _ in rows if i is not None)
    assert len(out) == len(rows)
    held = Counter(r["shard"] for r in out)
    sizes = [held.get(s, 0) for s in range(count)]
    assert max(sizes) - min(sizes) <= 1
    for shard, size in held.items():
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(size))


def apart(out):
    places = defaultdict(set)
    for r in out:
        places[r["text_crc32"], r["size"]].add(r["shard"])
    return sum(len(p) - 1 for p in places.values())


def test_groups_come_together(documents):
    rows = [(k, f"text {k % 25 if k < 100 else k}") for k in range(300)]
    out = shards.shard_documents(documents(rows)).collect()
    check_law(rows, out)
    assert apart(out) == 0
    assert not any(r["cut"] for r in out)


def test_group_larger_than_a_shard_is_cut_for_the_law(documents):
    rows = [(k, "same") for k in range(50)] + [(k, f"text {k}") for k in range(50, 120)]
    out = shards.shard_documents(documents(rows)).collect()
    check_law(rows, out)
    # 50 rows need four shards of 15.
    assert apart(out) <= 7


def test_everything_is_linked(documents):
    rows = [(k, f"text {k % 40}") for k in range(200)]
    out = shards.shard_documents(documents(rows)).collect()
    check_law(rows, out)
    # By chance a text's five rows would lie in four shards.
    assert apart(out) <= 60


def test_rows_of_every_kind(documents):
    long = "é" * 200_000
    rows = [(1, None), (2, ""), (None, "x"), (None, "x"), (3, "x"), (3, "x"), (4, long)]
    out = shards.shard_documents(documents(rows)).collect()
    check_law(rows, out)
    facts = {(r["doc_id"], r["size"], r["text_crc32"]) for r in out}
    assert facts == {(1, 1, 0), (2, 1, 0), (None, 2, zlib.crc32(b"x")), (3, 2, zlib.crc32(b"x")), (4, 400_001, zlib.crc32(long.encode()))}
    assert {(r["law"], r["grown_shard"]) for r in out} == {("rows", None)}
    assert shards.shard_documents(documents([])).count() == 0


def test_moves_keep_the_quotas():
    wanted = {(0, 1): 5, (1, 2): 3, (2, 0): 4, (1, 0): 1, (3, 2): 2}
    allowed = shards._allowed(wanted, [0, 0, 1, 0])
    assert allowed == {(0, 1): 4, (1, 2): 3, (2, 0): 3, (1, 0): 1, (3, 2): 1}
    assert shards._allowed({}, [1]) == {}


@pytest.mark.parametrize("block", [7, 20_000])
def test_ranks_are_gapless(spark, monkeypatch, block):
    monkeypatch.setattr(shards, "RANK_BLOCK", block)
    rows = spark.range(1000).selectExpr("id", "id % 3 AS g")
    out = shards.ranked(rows, ["g"], ["id"], 1000, "rank").collect()
    for g in range(3):
        assert sorted(r["rank"] for r in out if r["g"] == g) == list(range(sum(r["g"] == g for r in out)))


def test_table_cuts_fewer_than_it_must_not(sf):
    docs = sf("documents", "0.01")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    out = shards.shard_documents(docs).collect()
    check_law(rows, out)
    assert apart(out) == 0


def test_large_groups_come_together(documents):
    rows = [(k, f"text {k % 3 if k < 9000 else k}") for k in range(30_000)]
    out = shards.shard_documents(documents(rows)).collect()
    check_law(rows, out)
    # Three groups of 3,000 rows, shards of 3,750.
    assert apart(out) == 0
    assert not any(r["cut"] for r in out)


def test_groups_that_fill_the_shards_come_together(documents):
    rows = [(k, f"text {k % 40}") for k in range(200)]
    out = shards.shard_documents(documents(rows)).collect()
    check_law(rows, out)
    assert apart(out) == 0


def test_a_cut_group_has_few_pieces(documents):
    rows = [(k, "same") for k in range(50)] + [(k, f"text {k}") for k in range(50, 120)]
    out = shards.shard_documents(documents(rows)).collect()
    check_law(rows, out)
    assert apart(out) == 3
    assert sum(r["cut"] for r in out) == 35


def test_packing_takes_all_rows_within_the_quotas():
    counts = {(50, 0): 1, (7, 1): 3, (7, 2): 2, (2, 0): 30, (3, 3): 4}
    room = [40, 40, 40, 40]
    held, groups = Counter(), defaultdict(list)
    for whole, main, low, high, begin, end, target in shards._pack(counts, room):
        held[target] += (high - low) * (end - begin)
        for rank in range(low, high):
            groups[whole, main, rank].append((begin, end))
    assert all(held[s] <= 40 for s in range(4)) and sum(held.values()) == 157
    assert len(groups) == 40
    for (whole, _, _), parts in groups.items():
        parts.sort()
        assert parts[0][0] == 0 and parts[-1][1] == whole and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))


@pytest.mark.parametrize("common", [1, 30, 4096])
def test_links_are_the_same_whichever_texts_are_common(spark, monkeypatch, common):
    monkeypatch.setattr(shards, "COMMON", common)
    texts = ["same"] * 40 + ["pair", "pair", "one", "three", "three", "three"]
    rows = spark.createDataFrame([(k, t.encode()) for k, t in enumerate(texts)], "row long, text_key binary")
    links = sorted(map(tuple, shards.group_links(rows, len(texts)).collect()))
    assert links == [(0, k) for k in range(1, 40)] + [(40, 41)] + [(43, 44), (43, 45)]
