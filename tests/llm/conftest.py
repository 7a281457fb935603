import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(ROOT / "tests"), str(ROOT / "tests" / "llm")]

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def vocabulary():
    from gridmotion.llm.queries import vocabulary

    return vocabulary()


@pytest.fixture
def documents(spark):
    """Documents from texts, with ids 0.. or from (id, text) pairs, and clashing extra columns."""

    def make(texts, extra=()):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        schema = "doc_id long, text string" + "".join(f", `{c}` string" for c in extra)
        return spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], schema)

    return make
