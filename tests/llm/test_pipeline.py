"""The pipeline's stages against brute-force ones, each on what the stage before kept."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import plain  # noqa: E402

import corpus_pipeline  # noqa: E402
from inuring.llm.mixing import label_domains, mix  # noqa: E402


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, items = docs.columns, [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before = {r.doc_id: r.text for r in docs.collect()}
    kept = {
        "quality_rules": lambda d: {i for i, t in d.items() if plain.quality(t)[6]},
        "near_dedup": lambda d: {i for i, (_, c) in plain.near_groups(d.items()).items() if i == c},
        "decontamination": lambda d: {i for i, (_, hit, _) in plain.windows(d.items(), items).items() if not hit},
    }
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= set(before)
        if name in kept:
            assert set(ids) == kept[name](before)
        if name == "mixing":
            stage_docs = spark.read.parquet(str(tmp_path / str(k - 1)))
            whole = mix(stage_docs, label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet")), corpus_pipeline.FACTORS, relative=True, most=1.0).collect()
            assert set(ids) == {r.doc_id for r in whole if r.copies >= 1}
            for d in corpus_pipeline.FACTORS:  # 200 documents train next to nothing: the rates are the nearest fit
                wanted, has = (sum(k(r) * r.n_tokens * r.memberships[d] for r in whole) for k in (lambda r: r.rate, lambda r: r.doc_id in set(ids)))
                assert all(0 <= r.rate <= 1 for r in whole)
                assert abs(has - wanted) < 0.15 * sum(r.n_tokens * r.memberships[d] for r in whole), d
            assert len(ids) >= 0.7 * len(before)
        if name != "sharding":
            assert docs.columns == columns
            before = {i: before[i] for i in ids}
    assert set(ids) == set(before)
    counts = [r["count"] for r in docs.groupBy("shard").count().collect()]
    assert max(counts) - min(counts) <= 1
    assert corpus_pipeline.run(spark, sf_dir).count() == len(ids)


def test_empty_corpus(spark, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
