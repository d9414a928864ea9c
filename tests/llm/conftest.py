import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent.parent
sys.path.insert(0, str(ROOT))

from orderloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 8, **{"spark.ui.showConsoleProgress": "false",
                                                       "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def docs(spark):
    """Rows as documents, with a column that nothing should look at and names that operators use inside."""
    def make(*rows):
        return spark.createDataFrame([(*r, None, "x", 7) for r in rows],
                                     "doc_id bigint, text string, lang string, sha string, kept int")
    return make


@pytest.fixture
def sourced(spark):
    def make(*rows):
        return spark.createDataFrame(
            [(*r, "x", 7) for r in rows],
            "doc_id bigint, text string, source string, mix_source string, mix_copies int")
    return make
