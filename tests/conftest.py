import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from genomeloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    yield session
    session.stop()


@pytest.fixture
def write(tmp_path):
    def make(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        if name.endswith(".gz"):
            import gzip

            path.write_bytes(gzip.compress(text.encode()))
        else:
            path.write_text(text)
        return str(path)

    return make
