import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pagefeatures.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # spark.checkpoint.dir is read from the session; shared_dir() sets a
    # private one only when it is unset (local mode)
    s = get_session("local[4]", shuffle_partitions=4, conf={"spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tmp_shared(spark):
    from pagefeatures.session import shared_dir
    return shared_dir(spark)
