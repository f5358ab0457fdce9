import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) tuples."""
    def make(rows, parts=3):
        full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "src1")), len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return make
