"""The pipeline's stages on a small corpus, and the registered names."""

from __future__ import annotations

import random

import corpus_pipeline

import __spark_entry__
from siltstone.llm import lshforest, outliers

from .test_corpus import near_copies, prose


def test_names():
    names = [n for n in __spark_entry__.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries() and 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages(spark, tmp_path):
    rng = random.Random(2)
    clean = [prose(rng, rng.randint(60, 200)) for _ in range(120)]
    texts = clean + near_copies(rng, clean[0], 5) + [clean[1] + " mail x.y@z.org"] + ["%%% $$$ " * 100] * 5 + [None, "", "short"]
    rows = [(i, t, "en", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    docs = spark.read.parquet(path)
    columns, kept = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept.append(docs)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in kept]
    assert ids[0] == {r.doc_id for r in outliers.judge(spark.read.parquet(path)).where("kept").collect()}
    assert set(range(120)) <= ids[0] and not ids[0] & {127, 130, 131, 132, 133}
    assert ids[1] == {r.class_id for r in lshforest.classify(kept[0]).collect()}
    assert ids[2] == ids[1] and ids[3] <= ids[2] and ids[4] == ids[3]
    assert kept[2].where("text like '%@%'").count() == 0
    assert kept[4].where("size(ids) <> n_tokens or ids[0] <> 1").count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == kept[4].count()
