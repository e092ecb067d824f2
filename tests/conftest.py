import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tamarind.session import local_session  # noqa: E402
from tamarind.sources.tables import SCHEMAS, Tables, schema_of  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", "8", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "8g"})


@pytest.fixture(scope="session")
def frame(spark):
    """A logical table from dicts; columns not given are NULL."""

    def build(name, rows):
        schema = schema_of(name)
        return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)

    return build


@pytest.fixture(scope="session")
def tables(frame):
    """All logical tables, empty unless given."""

    def build(**rows):
        return Tables({name: frame(name, rows.get(name, [])) for name in SCHEMAS})

    return build
