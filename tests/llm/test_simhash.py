import random

import numpy as np
import pytest
import xxhash

from riskspark.llm.components import components
from riskspark.llm.simhash import fingerprint, keep_one, links, near_duplicates, spanning_links


def plain_fingerprint(text, k=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\v\f\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = ([" ".join(words[i:i + k]) for i in range(len(words) - k + 1)]
                if len(words) >= k else [" ".join(words)])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, pairs):
    up = list(range(n))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return [top(i) for i in range(n)]


def brute_components(fps, max_bits=4):
    return roots(len(fps), [(i, j) for i in range(len(fps)) for j in range(i)
                            if (fps[i] ^ fps[j]).bit_count() <= max_bits])


@pytest.mark.parametrize("text", ["", " \t\n", "One", "a B c", "The same words, the same words, the same",
                                  "É é x y a\x0bb c d e f", "x " * 5000])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_documents_against_brute_force(documents):
    docs = sorted((r.doc_id, r.text) for r in documents.collect())
    fps = [plain_fingerprint(t) for _, t in docs]
    want = brute_components(fps)
    got = sorted(near_duplicates(documents).collect())
    assert [r.fingerprint for r in got] == [f"{f:016x}" for f in fps]
    assert [r.component_id for r in got] == [docs[i][0] for i in want]
    assert len({r.component_id for r in got}) < len(got)


@pytest.mark.parametrize("block", [8192, 40])
def test_links_of_tight_clusters(spark, monkeypatch, block):
    """Random fingerprints and dense clusters, also with buckets cut into blocks."""
    import riskspark.llm.simhash as simhash

    monkeypatch.setattr(simhash, "BLOCK_ROWS", block)
    rng = random.Random(block)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(150):
            own = centre
            for bit in rng.sample(range(64), rng.randint(0, 6)):
                own ^= 1 << bit
            fps.add(own)
    fps = sorted(fps)
    want = brute_components(fps)
    table = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint")
    got = links(table).collect()
    at = {f: i for i, f in enumerate(fps)}
    pairs = [(at[r.a % (1 << 64)], at[r.b % (1 << 64)]) for r in got]
    assert all((fps[a] ^ fps[b]).bit_count() <= 4 for a, b in pairs)
    assert roots(len(fps), pairs) == want


def test_spanning_links_are_few():
    rng = np.random.default_rng(0)
    base = np.uint64(rng.integers(1 << 62))
    fps = np.unique(base ^ (np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64)))
    found = spanning_links(fps, np.zeros(len(fps), np.int64), 4)
    assert len(found) == len(fps) - 1


def test_components(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)]
    pairs += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)] + [(7, 7)]
    rng.shuffle(pairs)
    want = roots(400, pairs)
    got = {r.node: r.root for r in components(
        spark.createDataFrame(pairs, "a bigint, b bigint"), "a", "b").collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {i: want[i] for i in linked}
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").collect() == []


def test_odd_rows(make_docs, odd):
    got = near_duplicates(make_docs(odd, fp=1, component_id="x")).collect()
    assert len(got) == len(odd)
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {1}
    assert {r.component_id for r in got if r.doc_id in (5, 11)} == {5}
    assert [r.component_id for r in near_duplicates(make_docs([(None, "a b"), (None, "c d")])).collect()] == [None] * 2
    assert near_duplicates(make_docs([])).collect() == []


def test_keep_one(make_docs, odd):
    kept = keep_one(make_docs(odd, extra=1)).collect()
    ids = [r.doc_id for r in kept]
    assert ids.count(5) == 1 and 11 not in ids and 1 in ids and 2 not in ids
    assert kept[0].__fields__[-1] == "extra"


def test_keep_one_of_rows_that_share_an_id(make_docs):
    three, nine = ("the old mill stands by the river and grinds the corn of three villages",
                   "nine grey gulls follow a small boat out of the harbour every windy morning")
    docs = make_docs([(7, three), (7, nine), (3, three), (9, nine), (7, nine), (None, three), (None, "a b c"),
                      (None, "a b c"), (7, "something else altogether, which copies nothing")])
    kept = sorted((r.doc_id or 0, r.text) for r in keep_one(docs).collect())
    assert kept == [(0, "a b c"), (3, three), (7, nine), (7, "something else altogether, which copies nothing")]
