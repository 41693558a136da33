import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in zip(ids, texts)], SCHEMA)
    return make
