import os
import sys
import uuid
import zipfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import blobframe as bf  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = bf.build_session(
        {
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        }
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table_name():
    return f"default.t_{uuid.uuid4().hex}"


@pytest.fixture
def make_zip(tmp_path):
    """Write an archive of (name, content) pairs in the given order; returns its path."""

    def make(members, name="a.zip", compression=zipfile.ZIP_DEFLATED, prefix=b""):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True, parents=True)
        with open(path, "wb") as out:
            out.write(prefix)
            with zipfile.ZipFile(out, "w", compression) as archive:
                for member, content in members:
                    archive.writestr(member, content)
        return str(path)

    return make
