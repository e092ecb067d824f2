import pytest


@pytest.fixture()
def docs(spark):
    """Rows of ``documents`` from (doc_id, text) or (doc_id, text, lang, source)."""

    def build(rows):
        full = [(*r, *[None] * (4 - len(r)), len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return build
