import random

import pytest

from riskspark.llm.anchors import NULL_ID, drop_repeats, repeated_spans

SMALL = {"window": 7, "period": 3, "cover": (0, 1)}


def brute(rows, window=50):
    first, split = {}, [(i, NULL_ID if i is None else i, (t or "").encode().split()) for i, t in rows]
    for _, key, words in split:
        for s in range(len(words) - window + 1):
            at = tuple(words[s:s + window])
            first[at] = min(first.get(at, key), key)
    out = []
    for i, key, words in split:
        gone = {s + k for s in range(len(words) - window + 1) for k in range(window)
                if first[tuple(words[s:s + window])] < key}
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone).decode()
        out.append((i, len(words), len(gone), kept))
    return sorted(out, key=str)


def check(docs, rows, **how):
    got = sorted((tuple(r) for r in drop_repeats(docs, **how).collect()), key=str)
    assert got == brute(rows, how.get("window", 50))
    return got


@pytest.fixture
def short_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def shared(seed, docs=60, kinds=4):
    """Documents of few words, and passages that many of them share, some with changes."""
    pick = random.Random(seed)
    passages = [[f"w{pick.randrange(kinds)}" for _ in range(pick.randint(5, 40))] for _ in range(4)]
    out = []
    for i in range(docs):
        words = []
        for _ in range(pick.randint(0, 4)):
            own = list(pick.choice(passages))
            if pick.random() < 0.4:
                own[pick.randrange(len(own))] = "changed"
            words += own + [f"x{pick.randrange(50)}" for _ in range(pick.randint(0, 9))]
        out.append((i, " ".join(words)))
    return out


def test_odd_rows(make_docs, odd):
    rows = odd + [(20 + i, " ".join(f"w{k}" for k in range(i, 120))) for i in range(0, 90, 9)]
    got = check(make_docs(rows, source="clash", spans=1, mark="m", doc=3, lo=0, kind=1), rows)
    assert any(n for _, _, n, _ in got)


@pytest.mark.parametrize("seed", range(4))
def test_small_windows_against_brute_force(make_docs, seed):
    check(make_docs(rows := shared(seed), parts=5), rows, **SMALL)


def test_batches_that_cut_groups(make_docs, short_batches):
    rows = shared(9, 80, 2)
    check(make_docs(rows, parts=6), rows, **SMALL)


def test_every_offset_of_a_shared_passage(make_docs):
    passage = " ".join(f"p{k}" for k in range(50))
    rows = [(i, " ".join(f"a{i}_{k}" for k in range(i)) + " " + passage + f" end{i}") for i in range(64)]
    got = check(make_docs(rows, parts=4), rows)
    assert sorted(n for _, _, n, _ in got) == [0] + [50] * 63


def test_one_word_less_than_a_window_stays(make_docs):
    passage = " ".join(f"p{k}" for k in range(49))
    rows = [(i, f"l{i} {passage} r{i}") for i in range(30)]
    assert not any(n for _, _, n, _ in check(make_docs(rows), rows))


def test_a_third_of_the_rows_share_an_id_or_a_passage(make_docs):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(None if i % 3 == 0 else i, f"{passage} own {i}") for i in range(300)]
    rows += [(7000 + i, " ".join(f"q{k}" for k in range(80))) for i in range(150)]
    check(make_docs(rows, parts=6), rows)


def test_a_long_document_of_one_word(make_docs):
    rows = [(1, "w " * 20_000), (2, "w " * 70), (3, "w " * 49), (4, "v " + "w " * 55)]
    check(make_docs(rows), rows)


def test_given_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    check(documents.repartition(6), rows)


def test_empty_table_and_bad_cover(make_docs):
    assert drop_repeats(make_docs([]).where("false")).count() == 0
    with pytest.raises(ValueError, match="cover"):
        repeated_spans(make_docs([(1, "a")]), 50, 7, (0, 1))
