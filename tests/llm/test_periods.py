import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm.periods import collapse_runs, run_digests, tiles_of
from riskspark.llm.queries import with_planted_periods


def runs_of(words):
    """Every run by looking at every period from the smallest on."""
    found, x = {}, np.array([hash(w) for w in words])
    for q in range(1, len(words) // 4 + 1):
        edges = np.flatnonzero(np.diff(np.r_[False, x[:-q] == x[q:], False]))
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
    return sorted((a, q, b - a) for (a, b), q in found.items())


def brute(text):
    words = (text or "").encode().split()
    runs = runs_of(words)
    gone = {i for a, q, n in runs for i in range(a + q, a + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = max(runs, key=lambda r: (Fraction(r[2], r[1]), -r[0], -r[1]), default=None)
    lines = "".join(f"{a},{n},{q}\n" for a, q, n in runs).encode()
    return (len(runs), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4),
            hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


def check(docs, rows, **how):
    got = run_digests(collapse_runs(docs, **how)).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
        "collapsed_sha256").collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(str((i, *brute(t))) for i, t in rows)


def made(seed, size):
    pick, words = random.Random(seed), []
    kinds = pick.choice([1, 2, 3, 30])
    while len(words) < size:
        block = [f"w{pick.randrange(kinds)}" for _ in range(pick.randint(1, pick.choice([2, 9, 60])))]
        words += (block * 9)[:pick.randint(1, 8 * len(block))]
        words += [f"x{pick.randrange(9)}" for _ in range(pick.randint(0, 12))]
    return " ".join(words[:size])


THUE_MORSE = " ".join("ab"[bin(i).count("1") % 2] for i in range(3000))
FIBONACCI = ["a", "a b"]
while len(FIBONACCI[-1]) < 3000:
    FIBONACCI.append(f"{FIBONACCI[-1]} {FIBONACCI[-2]}")
TEXTS = [made(s, n) for s in range(12) for n in (5, 6, 7, 40, 333)] + [
    THUE_MORSE, FIBONACCI[-1], "same " * 900, "a b " * 3, "a a a a a", "a a a a a a", "a b a b a b a",
    "a b a b a b a b", "A a A a A a A a", "x" + " y z" * 200 + " y", "one two " * 6]


@pytest.mark.parametrize("how", [{}, {"long_chars": 1, "tile": 1}, {"long_chars": 300, "tile": 64}])
def test_against_brute_force(make_docs, odd, how):
    rows = odd + list(enumerate(TEXTS, 100))
    check(make_docs(rows, source="clash", runs=1, doc=2, mark="m", period=0), rows, **how)


def test_whole_documents(documents):
    rows = [(r.doc_id, r.text) for r in with_planted_periods(documents).collect() if len(r.text) < 9000]
    small = with_planted_periods(documents).where(F.char_length("text") < 9000)
    check(small.repartition(5), rows)


def test_a_run_over_many_tiles_is_one(make_docs):
    block = [f"w{i}" for i in range(37)]
    text = " ".join(["head"] + block * 60 + block[:5] + ["tail"])
    got = collapse_runs(make_docs([(1, text)]), long_chars=1, tile=16).collect()
    assert [tuple(r) for r in got[0].runs] == [(1, 37, 37 * 60 + 5)]
    assert got[0].text.split() == ["head", *block, "tail"]


def test_tiles_overlap_and_reach_the_end():
    for size in (1, 6, 100, 5000):
        for tile in (1, 64, 1 << 16):
            by_octave = {}
            for octaves, at, end in tiles_of(size, tile):
                for k in octaves:
                    by_octave.setdefault(k, []).append((at, end))
            assert set(by_octave) >= set(range((size // 4).bit_length()))
            for k, tiles in by_octave.items():
                assert tiles[0][0] == 0 and tiles[-1][1] == size
                assert all(a[1] == size or b[0] + 5 * 2 ** k <= a[1]
                           for a, b in zip(tiles, tiles[1:], strict=False))


def test_rows_of_one_id(make_docs):
    rows = [(None, f"{'a b ' * (i % 7)} {i}") for i in range(300)] + [(i, "p q r " * 5) for i in range(600)]
    rows += [(None, "z " * 9)] * 200
    check(make_docs(rows, parts=4), rows)


def test_empty_table(make_docs):
    assert run_digests(collapse_runs(make_docs([]).where("false"))).count() == 0


def test_planted_periods(make_docs, odd):
    rows = odd + [(i, " ".join(f"w{k}" for k in range(n))) for i, n in enumerate(range(0, 400, 7), 1000)]
    want = []
    for i, text in rows:
        words, h = (text or "").encode().split(), None if i is None else zlib.crc32(str(i).encode())
        if h is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = b" ".join(words[k if k < a else a + (k - a) % p] for k in range(n)).decode()
        want.append((i, text))
    got = [tuple(r) for r in with_planted_periods(make_docs(rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert got != rows
