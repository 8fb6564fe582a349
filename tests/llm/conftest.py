import pytest


@pytest.fixture
def frame(spark):
    """Documents of (doc_id, text) rows with extra columns whose names operators use themselves."""

    def build(rows):
        rows = [(i, t, "en", "src0", len(t or ""), -1, "x", 9) for i, t in rows]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, node long, size string, uid int"
        )

    return build
