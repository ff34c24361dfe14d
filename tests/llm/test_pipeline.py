import corpus_pipeline
from matchforge.llm.common import stage
from matchforge.llm.decontaminate import leaks
from matchforge.llm.quality import quality_verdicts
from matchforge.llm.queries import oracle_sql, queries
from matchforge.llm.secret_scan import redact_secrets, scan_secrets
from matchforge.llm.simhash import simhash_components

SF = "/root/testdata/sf0.001"


def test_stages_do_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    results = []
    for name, step in corpus_pipeline.STAGES:
        out = stage(step(spark, docs, SF), name)
        results.append((docs, out))
        docs = out
    ids = lambda df, c="doc_id": {r[c] for r in df.select(c).collect()}
    assert all(out.columns == columns for _, out in results[:-1])
    before, after = results[0]
    assert ids(after) == ids(quality_verdicts(before).where("kept"))
    before, after = results[1]
    assert ids(after) == ids(simhash_components(before), "component_id")
    before, after = results[2]
    assert ids(after) == ids(before) - ids(leaks(before, spark.read.parquet(f"{SF}/benchmark.parquet")))
    before, after = results[3]
    assert ids(after) == ids(before)
    found = {(r["doc_id"], r["value"]) for r in scan_secrets(before).where("is_secret").collect()}
    texts = dict(after.select("doc_id", "text").collect())
    for i, t in before.select("doc_id", "text").collect():
        own = [v for d, v in found if d == i]
        assert (texts[i] == t) == (not own) and not any(v in texts[i] for v in own)
    before, after = results[4]
    texts = dict(before.select("doc_id", "text").collect())
    assert {r["doc_id"]: r["decoded"] for r in after.collect()} == texts


def test_run_equals_its_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and out.where("not lossless").count() == 0


def test_stages_handle_odd_rows(spark, odd, none):
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, none, SF).count() == 0
        if name != "sentencepiece_encoding":
            assert step(spark, odd, SF).columns == odd.columns
    assert redact_secrets(odd).count() == odd.count()


def test_registered():
    assert [k.split("_")[0] for k in queries()] == [f"op{n}" for n in range(1, 14)] + ["pipeline"]
    assert set(oracle_sql()) <= set(queries())
