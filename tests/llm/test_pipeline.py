import re

import pytest

import corpus_pipeline
from tests.llm import test_jaccard as jaccard_tests
from tests.llm import test_packing as packing_tests
from tests.llm import test_pii as pii_tests
from tests.llm import test_quality as quality_tests

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(base / name))
        docs = spark.read.parquet(str(base / name))
        out.append(docs)
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_stay(steps):
    assert all(s.columns == steps[0].columns for s in steps[1:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicate", "pii", "packing"]


def test_toxic_documents_go_and_others_stay(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    kept = set(ids(steps[1]))
    clean = [r.doc_id for r in labels if r.toxic == 0]
    toxic = [r.doc_id for r in labels if r.toxic == 1]
    assert sum(i in kept for i in clean) >= 0.98 * len(clean)
    assert sum(i in kept for i in toxic) <= 0.35 * len(toxic)  # few examples at this size; test_toxicity.py has more


def test_quality(steps):
    before = {r.doc_id: r.text for r in steps[1].collect()}
    kept = set(ids(steps[2]))
    failed = {i for i, t in before.items() if quality_tests.brute(t)[5]}
    assert not kept & failed
    assert len(kept) >= 0.9 * len(before.keys() - failed)


def test_one_of_each_near_duplicate_class(steps):
    docs = [(r.doc_id, r.text) for r in steps[2].collect()]
    assert ids(steps[3]) == sorted({c for _, c, _, _ in jaccard_tests.brute(docs)})


def test_personal_data_is_gone(steps):
    before = {r.doc_id: r for r in steps[3].collect()}
    after = {r.doc_id: r for r in steps[4].collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        spans, text = pii_tests.brute(before[i].text), before[i].text
        assert r.n_chars == len(r.text)
        if not spans:
            assert r.text == text or "[" in r.text
        else:
            assert r.text != text
            marks = len(re.findall(r"\[(?:EMAIL|IP|CARD|PHONE|IBAN)\]", r.text))
            assert marks >= 1
            assert not [s for s in pii_tests.brute(r.text) if s[0] == "email"]


def test_packing_of_what_is_left(steps):
    docs = [(r.doc_id, r.text) for r in steps[4].collect()]
    packing_tests.check(steps[5].collect(), docs)


def test_run_gives_the_same(spark, steps):
    key = lambda df: sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(steps[5])


def test_columns_with_clashing_names(spark):
    """The values of all columns come out as they went in, whatever the columns are called."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 200")
    names = ["score", "evidence", "pii", "n_words", "kept", "__first", "__n", "first_id", "node", "weight", "toxicity_score", "document", "char_hist", "class_id"]
    more = docs.select("*", *[docs.doc_id.cast("string").alias(n) for n in names])
    columns = more.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        more = corpus_pipeline.stored(stage(spark, more, SF), name)
        assert more.columns == columns
        rows = more.collect()
        assert rows and all(r[n] == str(r.doc_id) for r in rows for n in names), name
    packing_tests.check(corpus_pipeline.STAGES[-1][1](spark, more, SF).collect(), [(r.doc_id, r.text) for r in rows])


def test_nulls_repeats_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", "en", "s", 0), (-1, None, "en", "s", None)], docs.schema)
    mixed = docs.unionByName(docs.where("doc_id < 5")).unionByName(odd)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        done = stage(spark, mixed, SF)
        assert done.count() > 0, name
    once = corpus_pipeline.near_duplicate(spark, mixed, SF)
    assert once.where("doc_id is not null").count() == once.where("doc_id is not null").select("doc_id", "text").distinct().count()


def test_null_keys_are_decided_row_by_row(spark):
    """A row with a null key gives way to a row like it, whatever other null keys there are; of null keys only, one stays."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    a, b = " ".join(f"first{i}" for i in range(60)), " ".join(f"second{i}" for i in range(60))
    left = lambda rows: sorted((r.doc_id is None, r.text) for r in corpus_pipeline.near_duplicate(spark, spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], schema), SF).collect())
    assert left([(1, a), (None, a)]) == [(False, a)]
    assert left([(1, a), (None, a), (None, b)]) == sorted([(False, a), (True, b)])
    assert left([(1, a), (None, a + " end"), (None, b)]) == sorted([(False, a), (True, b)])
    assert len(left([(None, b), (None, b + " end"), (None, b + " other"), (None, b)])) == 1
