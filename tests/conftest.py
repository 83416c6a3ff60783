import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from outletlab.session import drop_scratch, get_spark

    scratch = tempfile.mkdtemp(prefix="outletlab-tests-")
    session = get_spark("local[*]", 8, app_name="outletlab-tests",
                        extra={"spark.checkpoint.dir": f"{scratch}/checkpoints",
                               "spark.sql.warehouse.dir": f"{scratch}/warehouse"})
    yield session
    drop_scratch(session)
    session.stop()
