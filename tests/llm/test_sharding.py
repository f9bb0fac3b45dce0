import zlib

import pytest
from pyspark.sql import functions as F

from telemetra.llm import sharding
from telemetra.workspace import new_dir
from tests.llm.conftest import EDGES


def check(lines, texts, shards):
    found = {}
    for line in lines:
        found.setdefault(line["shard"], []).append(line["slot"])
        assert line["law"] == "bytes" and line["grown_shard"] is None
    assert all(sorted(slots) == list(range(len(slots))) for slots in found.values())
    assert set(found) <= set(range(shards))
    expected = sorted((repr(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts)
    assert sorted((repr(r["doc_id"]), r["size"], r["text_crc32"]) for r in lines) == expected


def loads(lines, shards):
    held = [0] * shards
    for line in lines:
        held[line["shard"]] += line["size"]
    return held


def test_bytes_are_even_and_equal_texts_stay_together(documents):
    texts = [(i, f"text {i // 3} " * (i % 50)) for i in range(3000)]
    lines = sharding.assign(documents(texts), shards=6).collect()
    check(lines, texts, 6)
    held = loads(lines, 6)
    assert max(held) < 1.02 * min(held)
    by_text = {}
    for line in lines:
        by_text.setdefault(dict(texts)[line["doc_id"]], set()).add(line["shard"])
    assert all(len(s) == 1 for s in by_text.values())


def test_a_hot_text_is_spread(documents, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_NUMBERED", 7)
    texts = [(i, "the same text again") for i in range(900)] + [(i, f"other {i}") for i in range(900, 1800)]
    lines = sharding.assign(documents(texts), shards=8, slots=256).collect()
    check(lines, texts, 8)
    held = loads(lines, 8)
    assert max(held) < 1.1 * min(held)


def test_edges(edges, documents):
    check(sharding.assign(edges).collect(), EDGES, 24)
    assert sharding.assign(documents([])).count() == 0


def test_rebalancing_edits_the_stored_map(spark):
    sizes = [(i * 37) % 101 + 1 for i in range(400)]
    first = sharding.first_map(sizes, 5)
    grown = sharding.rebalanced(first, sizes, 6)
    moved = [s for s in range(400) if first.shard_of[s] != grown.shard_of[s]]
    assert {grown.shard_of[s] for s in moved} == {5}
    held = [sum(sizes[s] for s in range(400) if grown.shard_of[s] == k) for k in range(6)]
    assert max(held) - min(held) <= 101 and len(moved) < 400 / 4
    shrunk = sharding.rebalanced(grown, sizes, 3)
    assert set(shrunk.shard_of) == {0, 1, 2} and shrunk.version == 3
    stayed = [s for s in range(400) if grown.shard_of[s] < 3]
    assert sum(grown.shard_of[s] != shrunk.shard_of[s] for s in stayed) < 20
    folder = new_dir(spark, "maps")
    spread = sharding.rebalanced(sharding.SlotMap(2, 6, grown.shard_of, (-5, 9)), sizes, 7)
    for slot_map in (first, grown, spread):
        sharding.write_map(spark, slot_map, folder)
    assert [sharding.read_map(spark, folder, v) for v in (1, 2, 3)] == [first, grown, spread]
    assert spread.spread == (-5, 9)


@pytest.mark.parametrize("before", [1, 500])
def test_later_copies_move_no_record(documents, spark, before):
    texts = [(i, f"other {i} " * 4) for i in range(400)] + [(i, "copied text") for i in range(400, 400 + before)]
    sizes = {"size": F.octet_length("text") + 8, "text_hash": F.xxhash64("text"), "placed_by": sharding.slot_of(F.xxhash64("text"))}
    base = documents(texts).withColumns(sizes)
    spread = sharding.groups_to_spread(base, 8)
    assert len(spread) == (before > 1)
    stored = sharding.first_map(sharding.slot_sums(base)[0], 8, spread)
    folder = new_dir(spark, "maps")
    sharding.write_map(spark, stored, folder)
    stored = sharding.read_map(spark, folder, 1)
    grown = texts + [(i, "copied text") for i in range(1000, 2500)]
    first = {r["doc_id"]: r for r in sharding.assign(documents(texts), 8, slot_map=stored).collect()}
    lines = sharding.assign(documents(grown), 8, slot_map=stored).collect()
    check(lines, grown, 8)
    then = {r["doc_id"]: r for r in lines}
    assert all((then[i]["virtual_slot"], then[i]["shard"]) == (r["virtual_slot"], r["shard"]) for i, r in first.items())
    unmapped = {r["doc_id"]: r["virtual_slot"] for r in sharding.assign(documents(grown), 8).collect()}
    assert unmapped == {i: r["virtual_slot"] for i, r in then.items()}


def test_a_stored_map_is_used_as_it_is(documents):
    slot_map = sharding.SlotMap(7, 2, tuple(i % 2 for i in range(sharding.VIRTUAL_SLOTS)))
    lines = sharding.assign(documents([(i, str(i)) for i in range(50)]), shards=2, slot_map=slot_map).collect()
    assert all(r["shard"] == r["virtual_slot"] % 2 and r["map_version"] == 7 for r in lines)


@pytest.mark.parametrize("shards", [1, 24])
def test_no_python_in_the_plan(documents, shards):
    plan = sharding.assign(documents([(1, "a")]), shards=shards).where(F.col("size") > 0)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
