import pytest

from tidemark.session import Workspace

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Build a documents table from (id, text) or (id, text, lang, source), with columns that clash with working names."""

    def build(rows, extra=True):
        full = [(*r, *[None] * (4 - len(r))) for r in rows]
        df = spark.createDataFrame([(i, t, la, s, None if t is None else len(t)) for i, t, la, s in full], DOCUMENTS)
        if extra:
            for name in ("id", "sig", "h", "s", "n", "row", "label", "score", "kind", "bucket", "words", "a", "b", "root", "rounds", "threshold"):
                df = df.selectExpr("*", f"'clash' AS {name}")
        return df

    return build


@pytest.fixture()
def shared(spark):
    return Workspace(spark)
