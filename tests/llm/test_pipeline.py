import corpus_pipeline
import pytest

import __spark_entry__ as entry
from salesflow.llm import packing, quality, secrets
from salesflow.llm.common import stored
from tests.llm.conftest import frame
from tests.llm.test_dedup import brute_components, brute_fingerprint, normal


def test_queries_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 11)}


def test_stages_against_brute_force(spark, small):
    """Every stage on what its predecessor kept, against plain loops over the rows."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    steps = []
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()} if name != "quality_rules" else {r["doc_id"]: r for r in docs.collect()}
        docs = stored(stage(spark, docs, small), name)
        steps.append((name, before, docs.collect()))
        if name != "best_fit_packing":
            assert docs.columns == columns
    steps = {name: (before, after) for name, before, after in steps}

    before, after = steps["quality_rules"]
    labels = spark.read.parquet(f"{small}/labels.parquet")
    source = spark.read.parquet(f"{small}/documents.parquet")
    model = quality.fit_quality(source, labels)
    verdict = {r["doc_id"]: r["kept"] for r in quality.quality_verdicts(source, model).collect()}
    assert sorted(r["doc_id"] for r in after) == sorted(i for i in before if verdict[i])

    before, after = steps["exact_dedup"]
    first = {}
    for i in sorted(before):
        first.setdefault(normal(before[i]["text"]), i)
    assert sorted(r["doc_id"] for r in after) == sorted(first.values())

    before, after = steps["simhash_near_dedup"]
    fps = [(i, brute_fingerprint(before[i]["text"])) for i in sorted(before)]
    assert sorted(r["doc_id"] for r in after) == sorted(set(brute_components(fps)))

    before, after = steps["secret_scans"]
    assert {r["doc_id"]: r["text"] for r in after} == {i: secrets.redacted(r["text"]) for i, r in before.items()}
    assert all(not secrets.scan(r["text"])[0] for r in after)

    before, after = steps["best_fit_packing"]
    whole = {}
    for r in after:
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["length"]
    assert whole == {i: len(r["text"].encode().split()) + 1 for i, r in before.items()}
    assert {r["bin_size"] for r in after} <= set(packing.SIZES)


@pytest.mark.parametrize("empty", [True, False])
def test_stages_on_odd_rows(spark, odd, small, empty, tmp_path):
    docs = frame(spark, []) if empty else odd
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, str(tmp_path)), name)
    assert docs.count() == (0 if empty else 8)  # the one long text is cut
