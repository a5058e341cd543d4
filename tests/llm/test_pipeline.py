"""The corpus pipeline on the smallest data, each stage against brute force."""

import collections
import os

import pytest

import corpus_pipeline
from claimlake.llm import mixing, quality
from tests.llm.test_operators import brute_groups, library, norm

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_stages(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    steps = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert k == len(stages) - 1 or out.columns == docs.columns, name
        out.write.parquet(f"{tmp_dir}/{k}")
        steps.append((docs, spark.read.parquet(f"{tmp_dir}/{k}")))
        docs = steps[-1][1]

    (start, good), (_, single), (_, apart), (_, mixed), (_, coded) = steps
    predicted = quality.quality_scores(start, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in predicted)

    last = {}
    for r in good.collect():
        last[norm(r.text)] = max(r.doc_id, last.get(norm(r.text), -1))
    assert sorted(r.doc_id for r in single.collect()) == sorted(last.values())

    items = [(r.doc_id, r.text) for r in single.collect()]
    _, groups = brute_groups(items, 5, 80)
    assert sorted(r.doc_id for r in apart.collect()) == sorted(min(items[i][0] for i in g) for g in groups)

    taken = collections.Counter(r.doc_id for r in mixed.collect())
    sizes = mixing.mixed_sizes(apart).collect()
    assert all(taken[r.doc_id] * r.size == r.taken for r in sizes)
    assert all(abs(sum(x.taken for x in sizes if x.target == t) / sum(1 for _ in {x.source_size for x in sizes if x.target == t}) - t)
               <= max(x.size for x in sizes) for t in {x.target for x in sizes})

    _, tok = library()
    texts = {r.doc_id: r.text for r in mixed.collect()}
    got = coded.collect()
    assert collections.Counter(r.doc_id for r in got) == taken
    assert all(list(r.ids) == tok.encode(texts[r.doc_id], add_special_tokens=False).ids for r in got)
