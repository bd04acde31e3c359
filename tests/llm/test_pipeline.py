import re

import corpus_pipeline
from tests.llm.test_decontaminate import brute
from tests.llm.test_bpe import ids
from tests.llm.test_simhash import brute_components, brute_print
from trowel.llm.common import read, stored

FOLDER = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    docs = read(spark, FOLDER, "documents")
    items = [(r.item_id, r.text) for r in read(spark, FOLDER, "benchmark").collect()]
    labels = {r.doc_id: r.toxic for r in read(spark, FOLDER, "labels").collect()}
    kept = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in kept}
        out = stored(stage(spark, docs, FOLDER), name)
        kept = out.collect()
        if name == "toxicity":
            gone = before.keys() - {r.doc_id for r in kept}
            assert all(labels.get(i, 1) == 1 for i in gone)
            assert not [r for r in kept if labels.get(r.doc_id) == 1 and re.search("idiot|moron", r.text)]
        elif name == "simhash_near_dedup":
            rows = list(before.values())
            want = brute_components([brute_print(r.text) for r in rows], [r.doc_id for r in rows])
            assert sorted(r.doc_id for r in kept) == sorted(set(want))
        elif name == "benchmark_decontamination":
            clean = [d for d, _, hit, _ in brute([(r.doc_id, r.text) for r in before.values()], items) if not hit]
            assert sorted(r.doc_id for r in kept) == sorted(clean)
        elif name == "secret_scans":
            assert {r.doc_id for r in kept} == before.keys()
            assert not [r for r in kept if re.search("AKIA[A-Z0-9]{12}|[0-9a-f]{32}", r.text)]
            assert all(r.n_chars == len(r.text) for r in kept if r.text != before[r.doc_id].text)
        else:
            assert {r.doc_id: list(r.ids) for r in kept} == {i: ids(r.text) for i, r in before.items()}
            break
        assert out.schema == docs.schema
        docs = out


def test_empty_documents(spark):
    docs = read(spark, FOLDER, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), "empty")
        assert docs.count() == 0


def test_odd_rows_and_columns(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, None, 1), (2, "", "en", "s", 0, 1), (2, "", "en", "s", 0, 1), (None, "no id here", "en", None, 10, 1),
         (5, "w " * 40_000, "en", "s", 80_000, 1)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, row_no int")
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stored(stage(spark, docs, FOLDER), "odd")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "row_no"]
    assert sorted(r.doc_id or 0 for r in docs.collect()) == [0, 1, 5]
