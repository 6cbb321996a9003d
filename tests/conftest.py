import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from funnelforge.session import checkpoint_dir, get_session

    import tempfile

    wh = tempfile.mkdtemp(prefix="funnelforge-tests-wh-")
    s = get_session("local[4]", 8, app_name="funnelforge-tests",
                    extra={"spark.driver.memory": "4g", "spark.sql.warehouse.dir": wh})
    checkpoint_dir(s)
    yield s
