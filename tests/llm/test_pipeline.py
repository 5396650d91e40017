"""The pipeline's stages against plain versions, each on what its predecessor kept."""

import os

import corpus_pipeline
import pytest
import public_tokenizers
import tiktoken

from millrace.llm import bpe, common, mix, quality

from test_dedup import plain_classes

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


def test_stages(spark, tmp_path):
    docs = common.table(spark, FOLDER, "documents")
    columns, kept = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert k == 4 or after.columns == columns
        kept.append(([tuple(r) for r in docs.select("doc_id", "text").collect()], after))
        docs = after
    ids = [sorted(r["doc_id"] for r in after.select("doc_id").collect()) for _, after in kept]

    scores = quality.scored(common.table(spark, FOLDER, "documents"), common.table(spark, FOLDER, "labels")).collect()
    assert ids[0] == sorted(r["doc_id"] for r in scores if r["score"] >= 0.7)
    last = {}
    for i, text in kept[1][0]:
        last[text] = max(i, last.get(text, -1))
    assert ids[1] == sorted(last.values())
    assert ids[2] == sorted(i for i, c in plain_classes(kept[2][0], 5, 80).items() if i == c)
    copies = mix.mixed(kept[2][1]).collect()
    assert ids[3] == sorted(r["row"]["doc_id"] for r in copies for _ in range(r["copies"]))
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = kept[4][1].select("doc_id", "ids").collect()
    assert sorted((r["doc_id"], r["ids"]) for r in got) == sorted((i, library.encode_ordinary(t)) for i, t in kept[4][0])
