import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for folder in (str(ROOT), str(ROOT / "tests")):
    if folder not in sys.path:
        sys.path.insert(0, folder)

from tidelight.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests")


@pytest.fixture(scope="session")
def sf_dir():
    if not Path(SF_DIR).is_dir():
        pytest.skip("test tables are not mounted")
    return SF_DIR
