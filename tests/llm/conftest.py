import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def shared(spark, tmp_path_factory):
    """The session with a checkpoint folder of its own, as a cluster would name one."""
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return spark


@pytest.fixture
def documents(shared):
    def make(rows):
        return shared.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in rows], DOCS)
    return make


@pytest.fixture(scope="session")
def sample(shared):
    """Small documents of the test data: every row of the smallest scale."""
    return shared.read.parquet("/root/testdata/sf0.001/documents.parquet")
