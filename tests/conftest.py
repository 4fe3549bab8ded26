from __future__ import annotations

import pytest

from tests.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        "tests",
        **{
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.sql.shuffle.partitions": "4",
        },
    )
    yield session
    session.stop()
