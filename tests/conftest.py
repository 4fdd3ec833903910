import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gaugelake import schemas as S  # noqa: E402
from gaugelake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Rows given as dicts to a DataFrame of a schema; absent columns are NULL."""
    from datetime import datetime

    def _make(schema, *rows):
        def value(field, row):
            v = row.get(field.name)
            if field.dataType.typeName() == "timestamp_ntz" and isinstance(v, str):
                v = datetime.fromisoformat(v)
            return v
        return spark.createDataFrame([tuple(value(f, r) for f in schema.fields) for r in rows], schema)
    return _make


@pytest.fixture(scope="session")
def obs(make):
    def _obs(*rows):
        base = {"source": "wsc", "ingest_ts": "2024-01-01", "value": 1.0}
        return make(S.OBSERVATION, *[{**base, **r} for r in rows])
    return _obs
