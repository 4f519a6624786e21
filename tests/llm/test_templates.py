import pytest

from riskspark.llm import templates
from riskspark.llm.templates import Wanted, contaminated, drop_contaminated, window_rows, Lexicon

ITEM = ("A farmer named Oscar sold 25 kg of apples to Maria for 3 dollars each while his neighbour "
        "Oscar carried 40 boxes over 12 km of road.")
OTHER = "Which of the following rivers flows through the largest number of different countries on the way to the sea?"


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, ITEM), (2, OTHER), (3, None), (4, ""), (None, "lost id here")],
                                 "item_id bigint, text string")


def pairs(df):
    return {(r.doc_id, r.item_id): r.verbatim for r in df.collect()}


def test_verbatim_new_values_and_inconsistent_values(make_docs, benchmark):
    swapped = (ITEM.replace("Oscar", "Peter").replace("Maria", "Lena").replace("25 kg", "90 kg")
               .replace("3 dollars", "8 dollars").replace("40 boxes", "11 boxes"))
    broken = ITEM.replace("Oscar sold", "Peter sold")  # one Oscar became Peter, the other did not
    docs = make_docs([f"Some words before. {ITEM} Some after.", f"x\n{swapped}\ny", broken,
                      "nothing of the kind at all", OTHER.upper(), OTHER[:40], None, ""])
    assert pairs(contaminated(docs, benchmark)) == {(0, 1): True, (1, 1): False, (4, 2): True}
    assert pairs(contaminated(docs, benchmark, table_bits=3)) == pairs(contaminated(docs, benchmark))
    kept = drop_contaminated(docs, benchmark)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 5, 6, 7]
    assert kept.columns == docs.columns


def test_documents_against_brute_force(spark, sf, documents):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    texts = {r.item_id: " ".join(r.text.lower().split()) for r in items.collect()}
    want = {(d.doc_id, i) for d in documents.collect() for i, t in texts.items()
            if t in " ".join(d.text.lower().split())}
    got = {(r.doc_id, r.item_id) for r in contaminated(documents, items).collect()}
    assert want <= got
    assert len(got) <= len(want) + 1


def test_window_rows_by_hand(spark):
    rows = list(window_rows(["He paid $5 to Ann Lee for 3 kg."], Lexicon(), 6, 2, None))
    assert [r[3] for r in rows] == ["he paid <num> to <name> <name>", "paid <num> to <name> <name> for",
                                    "<num> to <name> <name> for <num>", "to <name> <name> for <num> <unit>"]
    assert rows[0][4] == ["$5", "ann", "lee"]
    signed = int(rows[1][2]) - (int(rows[1][2]) >> 63 << 64)
    hashes = Wanted.of(spark.createDataFrame([(signed,)], "hash bigint"))
    assert len(list(window_rows(["He paid $7 to Bo Ek for 9 kg."], Lexicon(), 6, 2, hashes))) == 1


def test_odd_rows(make_docs, odd, benchmark, spark):
    assert contaminated(make_docs(odd, item_id=5, hash="x"), benchmark).collect() == []
    assert contaminated(make_docs([]), benchmark).collect() == []
    empty = spark.createDataFrame([], benchmark.schema)
    assert drop_contaminated(make_docs(odd), empty).count() == len(odd)
    twice = make_docs([(1, ITEM), (1, ITEM), (None, ITEM)])
    assert list(pairs(contaminated(twice, benchmark))) == [(1, 1)]


def test_short_and_number_heavy_items(make_docs, spark):
    items = ["What is the capital of France?", "12 + 7 = 19 and 19 + 8 = 27 then 27 - 5 = 22",
             "from Anna Berg, Carl Dahl, Eva Falk, Gustav Holm, Ida Juhl", "Why?"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    docs = make_docs([f"Some words stand before the item.\n{t}\nAnd a few more words stand after it." for t in items]
                     + ["What is the capital", "12 + 7 = 20 and 20 + 8 = 28 then 28 - 5 = 23", items[0], items[1]])
    want = {**{(i, i): True for i in range(4)}, (6, 0): True, (7, 1): True}
    assert pairs(contaminated(docs, benchmark)) == want
    assert pairs(contaminated(docs, benchmark, table_bits=3)) == want


def test_one_changed_word_leaves_the_other_windows(make_docs, spark, tmp_path):
    tail = " Then both of them went home by the old train that leaves at 6 every evening from the station near the lake."
    benchmark = spark.createDataFrame([(1, ITEM), (2, ITEM + tail)], "item_id bigint, text string")
    broken = ITEM.replace("Oscar sold", "Peter sold")
    # Every value is new, and the one that stands twice has become two: half of the short item's
    # windows hold it, but few of the long one's.
    mixed = (broken.replace("Oscar", "Anton").replace("Maria", "Lena").replace("25 kg", "90 kg")
             .replace("40 boxes", "11 boxes"))
    docs = make_docs([f"Before. {broken} After.", f"Before. {mixed + tail} After.", broken[:60]])
    got = pairs(contaminated(docs, benchmark, by_window=True))
    assert got == {(0, 1): True, (1, 2): False}
    assert pairs(contaminated(docs, benchmark)) == {}
    assert [r.doc_id for r in drop_contaminated(docs, benchmark, by_window=True).collect()] == [2]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    from riskspark.llm.queries import op6_decontamination
    assert pairs(op6_decontamination(spark, str(tmp_path))) == got


def test_names_in_other_letter_case(make_docs, spark):
    item = ("We saw how Oscar met Maria and then how Peter saw Lena near old Berlin while the aunt of "
            "Gustav took 25 kg of Danish pears to Anna who gave Bruno most of them.")
    benchmark = spark.createDataFrame([(1, item), (2, item.lower())], "item_id bigint, text string")
    docs = make_docs([f"Before. {x} After." for x in (
        item, item.lower(), item.upper(), item.upper().replace("25", "90"), item.title())] + [item[:40]])
    want = {(d, i): d != 3 for d in range(5) for i in (1, 2)}
    assert pairs(contaminated(docs, benchmark)) == want
    assert pairs(contaminated(docs, benchmark, table_bits=3)) == want


def test_rows_that_share_an_id_are_judged_alone(make_docs, benchmark):
    docs = make_docs([(1, ITEM), (1, "a clean text"), (1, None), (None, f"x {ITEM}"), (None, "clean too")])
    kept = {(r.doc_id, r.text) for r in drop_contaminated(docs, benchmark).collect()}
    assert kept == {(1, "a clean text"), (1, None), (None, "clean too")}


def test_new_numbers_against_what_was_made(spark, make_docs):
    """Items of plain words and four numbers, one of them twice, copied with other numbers."""
    import random

    pick = random.Random(5)
    items, docs, want = [], [], {}
    for i in range(40):
        words = [f"w{''.join(pick.choices('abcdefgh', k=4))}" for _ in range(30)]
        numbers = [str(n) for n in pick.sample(range(10, 99), 3)]
        places = sorted(pick.sample(range(3, 27), 4))
        values = [numbers[0], numbers[1], numbers[0], numbers[2]]

        def text(own, words=words, places=places):
            return " ".join(own[places.index(k)] if k in places else w for k, w in enumerate(words))

        other = {n: str(pick.randrange(100, 999)) for n in numbers}
        other[numbers[1]] = other[numbers[0]] + "1"
        items.append((i, text(values)))
        copies = [text(values), text([other[v] for v in values]),
                  text([other[numbers[0]], *[other[v] for v in values[1:2]], "5", other[values[3]]]),
                  " ".join("changed" if k % 6 == 0 else w for k, w in enumerate(text(values).split()))]
        for kind, copy in enumerate(copies):
            docs.append((10 * i + kind, f"before it {copy} and behind"))
        want |= {(10 * i, i): True, (10 * i + 1, i): False}
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    for bits in (3, 15, 20):
        assert pairs(contaminated(make_docs(docs), benchmark, table_bits=bits)) == want


def test_one_result_with_and_without_broadcast(spark, sf, documents, monkeypatch):
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    small = templates.drop_contaminated(documents, benchmark, by_window=True)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(templates, "BROADCAST_ROWS", -1)
    large = templates.drop_contaminated(documents, benchmark, by_window=True)
    kept = sorted(map(repr, small.collect()))
    assert kept == sorted(map(repr, large.collect())) and 0 < len(kept) < documents.count()
