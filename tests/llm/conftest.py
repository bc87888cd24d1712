import os

import pytest

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def ready(spark):
    from ledgerline.llm.common import importable

    importable(spark)
    return spark


@pytest.fixture
def docs(ready, tmp_path_factory):
    """Documents from (doc_id, text) pairs, written and read as a table is."""
    def make(rows):
        path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
        full = [(i, t, "en", "src/a", len(t or "")) for i, t in rows]
        ready.createDataFrame(full, DOC).coalesce(2).write.parquet(path)
        return ready.read.parquet(path)
    return make


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def texts(ready):
    rows = ready.read.parquet(f"{SF}/documents.parquet").collect()
    return {r["doc_id"]: r["text"] for r in rows}
