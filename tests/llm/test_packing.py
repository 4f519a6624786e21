import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from riskspark.llm.packing import pack_documents, plan_bins
from riskspark.llm.tokens import public_path

BYTES = public_path("byte_bpe_50k.json")


def best_two_fit(lengths, capacity):
    """Bin by bin, without counting equal bins."""
    left = sorted(lengths)
    bins = []
    while left:
        bin_, room = [], capacity
        for x in sorted(left, reverse=True):
            if x <= room:
                bin_.append(x)
                room -= x
                left.remove(x)
        small, best = bin_[-1], None
        if room:
            for i, a in enumerate(left):
                for b in left[i + 1:]:
                    if small < a + b <= room + small and (best is None or a + b > sum(best)):
                        best = (a, b)
        if best:
            bin_[-1:] = best
            left.remove(best[0])
            left.remove(best[1])
            left = sorted([*left, small])
        bins.append(bin_)
    return bins


@pytest.mark.parametrize("seed", range(8))
def test_plan_equals_the_plain_method(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 41, rng.integers(1, 120))
    counts = np.bincount(lengths, minlength=41)
    plan = plan_bins(counts, 40)
    used = np.zeros(41, np.int64)
    for bin_, times in plan:
        assert sum(bin_) <= 40
        used += np.bincount(bin_, minlength=41) * times
    assert (used == counts).all()
    plain = best_two_fit(lengths.tolist(), 40)
    assert abs(sum(t for _, t in plan) - len(plain)) <= 1
    assert sum(t for _, t in plan) >= -(-int(lengths.sum()) // 40)


def test_plan_of_many_pieces_is_short_and_tight():
    counts = np.zeros(1025, np.int64)
    counts[1:] = np.random.default_rng(0).integers(0, 10 ** 8, 1024)
    plan = plan_bins(counts)
    assert len(plan) < 4000
    total = int((counts * np.arange(1025)).sum())
    assert sum(t for _, t in plan) < 1.02 * total / 1024 + 1


def check(rows, want, capacity=1024):
    """Every id in its place, sequences gapless and within the capacity."""
    places, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, ids in want.items():
        at = 0
        own = sorted(pieces[doc_id], key=lambda r: r.piece)
        for number, r in enumerate(own):
            assert (r.piece, r.start) == (number, at)
            assert number == 0 or r.length == capacity
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
        assert len(own) == -(-len(ids) // capacity)
    return len(places)


def test_documents(documents):
    library = Tokenizer.from_file(BYTES)
    docs = documents.collect()
    want = {r.doc_id: e.ids + [2] for r, e in zip(docs, library.encode_batch(
        [r.text for r in docs], add_special_tokens=False), strict=True)}
    n = check(pack_documents(documents, BYTES).collect(), want)
    assert n <= 1.03 * sum(map(len, want.values())) / 1024 + 1


def test_odd_rows(make_docs, odd):
    library = Tokenizer.from_file(BYTES)
    rows = pack_documents(make_docs(odd, length="x", offset=5), BYTES).collect()
    single = {i: library.encode(t or "", add_special_tokens=False).ids + [2]
              for i, t in odd if i not in (None, 5)}
    check(rows, single)
    assert sum(r.length for r in rows) == sum(
        len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in odd)
    assert pack_documents(make_docs([]), BYTES).collect() == []
