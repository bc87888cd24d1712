"""The pipeline's stages, each against a brute-force version on what the one before kept."""
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from test_best_fit_packing import check_packing
from test_exact_dedup import expected as exact_groups
from test_jaccard_join import expected as near_groups
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerline.llm import quality_rules
from ledgerline.llm.common import stored


@pytest.fixture(scope="module")
def outputs(ready, sf):
    """Rows after each stage, the documents first."""
    docs = ready.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(ready, out[-1], sf), "test-stage"))
    return out


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "exact dedup", "n-gram Jaccard join", "secret scans", "best-fit packing"]
    for df in outputs[1:-1]:
        assert df.columns == outputs[0].columns and df.dtypes == outputs[0].dtypes


def test_workers_get_small_batches(outputs):
    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": pa.array([batch.num_rows], pa.int64())})
    spark = outputs[0].sparkSession
    found = spark.range(0, 6000, 1, 1).mapInArrow(rows, "rows bigint").collect()
    assert sum(r["rows"] for r in found) == 6000 and max(r["rows"] for r in found) <= corpus_pipeline.BATCH_ROWS
    before = spark.conf.get(corpus_pipeline._BATCH)
    spark.conf.set(corpus_pipeline._BATCH, "10")
    corpus_pipeline.workers(spark)
    assert spark.conf.get(corpus_pipeline._BATCH) == "10"  # smaller ones stay
    spark.conf.set(corpus_pipeline._BATCH, before)


def test_quality(ready, sf, outputs):
    judged = quality_rules.judged(outputs[0], ready.read.parquet(f"{sf}/labels.parquet"))
    assert set(texts_of(outputs[1])) == {r["doc_id"] for r in judged.where("kept").collect()}
    good = {r["doc_id"] for r in ready.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    base = {r["doc_id"] for r in judged.where("base_failed").collect()}
    assert good - base <= set(texts_of(outputs[1]))


def test_exact(outputs):
    rows = list(texts_of(outputs[1]).items())
    assert set(texts_of(outputs[2])) == {keep for keep, _ in exact_groups(rows).values()}


def test_near(outputs):
    rows = list(texts_of(outputs[2]).items())
    assert {str(i) for i in texts_of(outputs[3])} == {least for _, _, least in near_groups(rows, 5, 80)}


def test_secrets(outputs):
    before, after = texts_of(outputs[3]), texts_of(outputs[4])
    sure = re.compile(r"AKIA[0-9A-Z]{16}|password=[0-9a-f]{18}|token = \"[0-9a-f]{40}\"")
    assert set(before) == set(after)
    for doc_id, text in before.items():
        assert not sure.search(after[doc_id])
        if not sure.search(text):
            assert after[doc_id] == text


def test_packing(outputs):
    library, rows = Tokenizer.from_file(P.path("word_bpe_49k.json")), [r.asDict() for r in outputs[5].collect()]
    want = {}
    for doc_id, text in texts_of(outputs[4]).items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
        want.update({(doc_id, n): zlib.crc32(ids[at : at + 4096].tobytes()) for n, at in enumerate(range(0, len(ids), 4096))})
    assert {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in rows} == want
    used, least = check_packing(rows, 4096)
    assert used <= 1.03 * least + 1


def test_run(ready, sf, outputs):
    rows = corpus_pipeline.run(ready, sf).select("doc_id", "piece", "ids_crc32").collect()
    assert sorted(rows) == sorted(outputs[5].select("doc_id", "piece", "ids_crc32").collect())
