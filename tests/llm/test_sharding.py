"""The look-up table against a plain fill; placement; files."""

import hashlib

import pytest

from ledgerlens.llm import sharding as S


def plain_table(shards, size):
    number = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:15], 16)
    order = [[(number("offset:" + s) + j * (number("step:" + s) % (size - 1) + 1)) % size for j in range(size)]
             for s in shards]
    owner = {}
    turn = 0
    while len(owner) < size:
        i = turn % len(shards)
        slot = next(x for x in order[i] if x not in owner)
        owner[slot] = i
        turn += 1
    return [owner[k] for k in range(size)]


@pytest.mark.parametrize("n,size", [(1, 2), (3, 7), (5, 101), (16, 251)])
def test_table(n, size):
    shards = [f"s{i}" for i in range(n)]
    table = S.lookup_table(shards, size)
    assert table == plain_table(shards, size)
    sizes = [table.count(i) for i in range(n)]
    assert max(sizes) - min(sizes) <= 1


def test_few_slots_move_when_a_shard_goes():
    shards = [f"s{i}" for i in range(20)]
    before, after = S.lookup_table(shards, 2039), S.lookup_table(shards[:-1], 2039)
    moved = sum(b != a for b, a in zip(before, after) if b != 19)
    assert moved < 0.1 * 2039


def test_bad_parameters(edge):
    for shards, size in (([], 7), (["a", "a"], 7), (["a"], 8), (["a"] * 1, 1), ([f"s{i}" for i in range(9)], 7)):
        with pytest.raises(ValueError):
            S.lookup_table(shards, size)
    with pytest.raises(ValueError, match="exist already"):
        S.place(edge, ["doc_id"], ["a"], 7)


def test_placement_and_files(llm, edge, none, tmp_path):
    shards = [f"s{i}" for i in range(4)]
    out = S.place(edge, ["doc_id", "text"], shards, 101, "slot_", "shard_")
    assert out.columns == [*edge.columns, "slot_", "shard_"] and out.count() == edge.count()
    table = S.lookup_table(shards, 101)
    for r in out.collect():
        key = "\x1f".join("-" if v is None else f"={v}" for v in (r.doc_id, r.text))
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 101
        assert (r.slot_, r.shard_) == (slot, shards[table[slot]])
    assert S.place(none, ["doc_id"], shards, 101, "slot_", "shard_").count() == 0
    S.write_shards(edge.drop("shard"), ["doc_id"], shards, str(tmp_path / "out"), 101)
    back = llm.read.parquet(str(tmp_path / "out"))
    assert back.count() == edge.count() and set(back.columns) == set(edge.columns)
