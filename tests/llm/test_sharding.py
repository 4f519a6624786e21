import hashlib
import zlib
from collections import defaultdict

import pytest

from riskspark.llm import slots
from riskspark.llm.sharding import assign_shards


def jump(key, shards):
    """The published algorithm on whole numbers."""
    state = int(hashlib.md5(str(key if key is not None else "").encode()).hexdigest()[:16], 16)
    b, j = -1, 0
    while j < shards:
        b = j
        state = (state * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((state >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 24])
def test_against_the_published_loop(documents, shards):
    rows = assign_shards(documents, shards).collect()
    assert len(rows) == documents.count()
    taken = defaultdict(list)
    for r in rows:
        assert r.shard == jump(r.doc_id, shards)
        assert r.grown_shard == jump(r.doc_id, shards + 1)
        assert r.grown_shard in (r.shard, shards)
        taken[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in taken.values())


def test_bytes_and_crc(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in assign_shards(documents, 24).collect():
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")


def test_odd_rows(make_docs, odd):
    rows = assign_shards(make_docs(odd, shard=9, size="x", slot=1), 4).collect()
    assert len(rows) == len(odd)
    by_id = defaultdict(set)
    for r in rows:
        by_id[r.doc_id].add(r.shard)
        if r.doc_id in (1, 2):
            assert (r["size"], r.text_crc32) == (8, 0)
    assert all(len(s) == 1 for s in by_id.values())
    assert len({(r.shard, r.slot) for r in rows}) == len(odd)


@pytest.mark.parametrize("hot", [7, None])
def test_rows_of_one_id(make_docs, monkeypatch, hot):
    """A third of the rows bear one id, half of these one text; no part or run holds many."""
    monkeypatch.setattr(slots, "ROWS_PER_BUCKET", 20)
    items = ([(hot, f"text {i}") for i in range(300)] + [(hot, "copy")] * 300
             + [(100 + i, f"other {i}") for i in range(1200)])
    docs = make_docs(items)
    rows = assign_shards(docs, 5).collect()
    by_shard = defaultdict(list)
    for r in rows:
        assert r.shard == jump(r.doc_id, 5)
        by_shard[r.shard].append(r.slot)
    assert sum(map(len, by_shard.values())) == len(items)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    want = sorted((i if i is not None else -1, zlib.crc32(t.encode())) for i, t in items)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.text_crc32) for r in rows) == want
    again = assign_shards(docs.repartition(7), 5).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_empty_table_and_no_shards(make_docs):
    assert assign_shards(make_docs([]), 3).collect() == []
    with pytest.raises(ValueError):
        assign_shards(make_docs(["a"]), 0)


def test_plan_is_native(make_docs):
    plan = assign_shards(make_docs(["a"]), 3)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
