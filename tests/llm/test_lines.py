from collections import Counter

import numpy as np
import pytest

from riskspark.llm.cuckoo import CuckooFilter
from riskspark.llm.lines import LineIndex, drop_lines

SPACE = " \t\n\v\f\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(texts, min_docs, min_chars=1):
    texts = [t or "" for t in texts]
    docs = Counter(k for t in texts for k in {key(x) for x in t.split("\n")} if len(k) >= min_chars)
    return [[x for x in t.split("\n") if docs[key(x)] < min_docs] for t in texts]


@pytest.mark.parametrize("min_docs", [2, 10])
def test_against_brute_force(documents, min_docs):
    rows = documents.collect()
    want = {r.doc_id: "\n".join(k) for r, k in zip(rows, brute([r.text for r in rows], min_docs), strict=True)}
    got = drop_lines(documents, min_docs).collect()
    assert {r.doc_id: r.text for r in got} == want
    assert sum(r.n_dropped for r in got) > 0
    assert got[0].__fields__[:-2] == documents.columns


def test_hot_and_rare_keys(make_docs):
    """One line in every document, many lines in two each, more than 1024 pairs in all."""
    texts = [f"common\nUnder {i // 2} \n  own {i}\nkept" + " x" * (i % 3) for i in range(900)]
    got = {r.doc_id: r.text for r in drop_lines(make_docs(texts), 2).collect()}
    want = brute(texts, 2)
    assert [got[i] for i in range(len(texts))] == ["\n".join(k) for k in want]


def test_odd_rows(make_docs, odd):
    got = drop_lines(make_docs(odd, n_lines="old", _keys2=1), 3).collect()
    assert len(got) == len(odd)
    assert sorted((r.text, r.n_lines) for r in got) == sorted(
        ("\n".join(k), len((t or "").split("\n")))
        for k, (_, t) in zip(brute([t for _, t in odd], 3), odd, strict=True))
    assert all(r.n_dropped == 2 and r.text == "" for r in got if r.doc_id == 5)


def test_empty_table(make_docs):
    assert drop_lines(make_docs([])).collect() == []


def test_adding_and_removing_is_reversible(spark, make_docs):
    first = make_docs([f"a\nb {i % 3}\nc" for i in range(12)])
    second = make_docs([(100 + i, f"c\nb {i % 3}\nnew {i % 2}") for i in range(12)])
    index = LineIndex(spark, 4, min_docs=4)

    def state():
        from riskspark.llm.lines import _read

        counts = {(r.k1, r.k2): r.docs for r in index.counts.collect()}
        keys = set()
        for row in index.filters.toArrow().to_batches():
            for i in range(row.num_rows):
                import pyarrow as pa

                made, exact = _read(pa.Table.from_batches([row.slice(i, 1)]))
                k1 = exact["k1"].view(np.uint64) >> np.uint64(20)
                assert made.contains(k1, exact["k2"]).all()
                assert (made.table > 0).sum() == len(exact)
                keys |= {tuple(map(int, k)) for k in exact}
        assert keys == {k for k, n in counts.items() if n >= 4}
        return counts

    index.add(first)
    before = state()
    index.add(second)
    assert state() != before
    index.remove(second)
    assert state() == before
    index.remove(first)
    assert state() == {}


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    k1, k2 = (rng.integers(0, 2 ** 63, 50_000).astype(np.uint64) for _ in range(2))
    made = CuckooFilter.of(k1, k2)
    assert made.contains(k1, k2).all()
    o1, o2 = (rng.integers(0, 2 ** 63, 50_000).astype(np.uint64) for _ in range(2))
    assert made.contains(o1, o2).mean() < 0.001
    made.delete(k1[:30_000], k2[:30_000])
    assert made.contains(k1[30_000:], k2[30_000:]).all()
    assert (made.table > 0).sum() == 20_000
    made.delete(k1[30_000:], k2[30_000:])
    assert not made.table.any()


def test_names_of_its_own_in_the_table(make_docs):
    docs = make_docs(["a\nb", "a\nc", "a"], _keys=1, _of=2, _tag="t", _text_tag=3, k1=4, k2=5, shard=6)
    got = drop_lines(docs, 3).collect()
    assert sorted(r.text for r in got) == ["", "b", "c"]
    assert all((r._keys, r._of, r._tag, r._text_tag, r.k1, r.shard) == (1, 2, "t", 3, 4, 6) for r in got)


def test_a_third_of_the_rows_share_an_id(make_docs):
    rows = [(None if i % 3 == 0 else i, "\n".join([f"own {i}", *(f"line {(i + k) % 40}" for k in range(9))]))
            for i in range(1500)]
    got = drop_lines(make_docs(rows, parts=6)).collect()
    assert sorted(r.text for r in got) == sorted(f"own {i}" for i in range(1500))
    assert sum(r.doc_id is None for r in got) == 500


def test_index_cleans_by_what_is_added_now(spark, make_docs):
    first = [(i, f"a\nb {i % 3}\nc\nown {i}") for i in range(12)]
    second = [(100 + i, f"c\nb {i % 3}\nnew {i % 2}") for i in range(12)]
    asked = first[:4] + second[:4] + [(None, "A \nzzz\nnew 1"), (7, None), (7, ""), (8, "own 3\nown 3")]
    index = LineIndex(spark, 4, min_docs=6)

    def check(added):
        counts = {}
        for _, text in added:
            for key in set(text.split("\n")):
                counts[key] = counts.get(key, 0) + 1
        want = []
        for i, text in asked:
            lines = (text or "").split("\n")
            kept = [x for x in lines if counts.get(x.strip().lower(), 0) < 6]
            want.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
        got = index.clean(make_docs(asked, _tag=1, k1=2)).collect()
        assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got), key=str) == sorted(want, key=str)
        return want

    states = [check([])]
    index.add(make_docs(first))
    states.append(check(first))
    index.add(make_docs(second))
    states.append(check(first + second))
    index.remove(make_docs(first))
    states.append(check(second))
    assert len(set(map(str, states))) == 4
    assert index.clean(make_docs([]).where("false")).count() == 0
