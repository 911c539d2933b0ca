import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cases import ODD  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from cinelake.session import local_session
    session = local_session("*", shuffle_partitions=4, app="cinelake-llm-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def odd(spark):
    """Defined cases, with repeated rows, null ids and columns whose names clash."""
    rows = [(i, t, "en" if i % 2 else None, 7, "n") for i, t in enumerate(ODD)]
    rows += [(3, "One", "en", 7, "n"), (None, "null id", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, fp long, row string")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
