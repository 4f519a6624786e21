
from tokenizers import Tokenizer

import corpus_pipeline
from riskspark.llm import quality
from riskspark.llm.queries import ORACLES, QUERIES
from riskspark.llm.tokens import public_path

from test_lines import brute as brute_lines
from test_packing import check
from test_simhash import brute_components, plain_fingerprint


def test_run_against_brute_force(spark, sf, documents):
    """All stages by plain Python on the small tables; the classifier's own scores are taken."""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = [r for r in quality.keep_good(documents, labels).collect()]
    assert 0.5 * documents.count() < len(docs) < documents.count()
    texts = ["\n".join(k) for k in brute_lines([r.text for r in docs], 10)]
    rows = sorted(zip((r.doc_id for r in docs), texts, strict=True))
    groups = brute_components([plain_fingerprint(t) for _, t in rows])
    rows = [rows[i] for i in sorted(set(groups))]
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if not any(x in " ".join(t.lower().split()) for x in items)]
    library = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    want = {i: e.ids + [2] for (i, _), e in zip(rows, library.encode_batch(
        [t for _, t in rows], add_special_tokens=False), strict=True)}
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in got} == set(want)
    check(got, want)


def test_stages_keep_the_columns(spark, sf, make_docs, odd):
    docs = make_docs(odd, parts=2)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert out.count() <= docs.count()
    empty = make_docs([])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0, name


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
    import __spark_entry__ as entry

    assert {*QUERIES, "pipeline"} <= set(entry.queries())


def test_oracles(spark, sf):
    from checks.compare import compare, duck

    con = duck(sf)
    for name in ORACLES:
        good, note = compare(spark, con, name, QUERIES[name], ORACLES[name], sf)
        assert good, note
