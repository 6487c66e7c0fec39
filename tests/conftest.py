from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return get_session("tidemark-tests", cores=8, **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def dims(spark):
    from tidemark.sources.seeds import dimensions

    return dimensions(spark)
