import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from allocata.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, partitions=4, memory="4g", **{"spark.sql.files.maxPartitionBytes": "8m"})
    yield session
    session.stop()


DATA = "/root/testdata"
needs_data = pytest.mark.skipif(not Path(DATA, "sf0.001").exists(), reason="no test data")
