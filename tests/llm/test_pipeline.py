import corpus_pipeline as P
from ledgerlens.llm import language_id, mixing, toxicity
from ledgerlens.llm.common import load

SF = "/root/testdata/sf0.001"


def test_stages_in_order_and_their_effect(spark):
    docs = load(spark, SF, "documents")
    assert [n for n, _ in P.STAGES] == ["language ID", "toxicity", "SimHash near-dedup", "mixing sources to target weights", "best-fit packing"]
    kept = P.stage_language(spark, docs, SF)
    assert kept.columns == docs.columns
    pred = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids == {d for d, r in pred.items() if r["lang_pred"] != "und" and r["score"] >= P.LEAST_LANGUAGE}
    clean = P.stage_toxicity(spark, kept, SF)
    model = toxicity.train(kept.select("doc_id", "text"), load(spark, SF, "labels"))
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in kept.collect() if model.score(r["text"]) < 0.5}
    single = P.stage_near_dedup(spark, clean, SF)
    assert single.columns == docs.columns and 0 < single.count() <= clean.count()
    mixed = P.stage_mix(spark, single, SF)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in mixing.mix(single).collect())
    packed = P.stage_pack(spark, mixed, SF).collect()
    assert sum(r["piece"] == 0 for r in packed) == mixed.count()


def test_run(spark):
    out = P.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(out.columns)


def test_odd_rows_pass_all_stages(spark, docs_of):
    rows = [(1, "the good thing", "en", "a"), (1, "the good thing", "en", "a"), (2, None, None, None), (None, "und der nicht", "de", "b"), (3, "", "en", "a"), (4, "word " * 50_000, "en", None)]
    for rs in (rows, []):
        docs = docs_of(rs)
        for _, stage in P.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() >= bool(rs)
