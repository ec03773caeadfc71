import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from matchloom.session import local_session  # noqa: E402

# Started here because test modules build column expressions when they are imported.
SPARK = local_session(8, **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def spark():
    return SPARK


@pytest.fixture
def rows():
    """Result rows as plain tuples, in a stable order."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)
    return collect
