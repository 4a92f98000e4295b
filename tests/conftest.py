import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelloom.session import local_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture(scope="session")
def feature_panel(spark):
    """The clean panel of the small test tables, built once."""
    from panelloom.catalog import plans_q
    from panelloom.catalog.fixtures import Tables
    return plans_q._clean(Tables(spark, f"{DATA}/sf0.01"))
