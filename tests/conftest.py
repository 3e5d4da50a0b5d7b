import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from small_tables import SMALL  # noqa: E402

from watchledger.session import build_session  # noqa: E402
from watchledger.sources.fixtures import Tables  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return build_session("tests", "local[8]", 4)


@pytest.fixture(scope="session")
def tables(spark):
    return Tables(spark, SMALL)


@pytest.fixture(scope="session")
def incidents_pdf(tables):
    return tables.prepared.toPandas()


@pytest.fixture()
def make_incidents(spark):
    """Incident rows from (event_id, timestamp, source_ip) and optional columns."""
    from watchledger.schemas import INCIDENTS
    from watchledger.sources.readers import _nullable

    defaults = {"event_type": "Malware", "severity": "High", "destination_device": "Device-1", "status": "Failed", "location": "Brazil"}

    def build(rows):
        full = [{**defaults, **r} for r in rows]
        return spark.createDataFrame([tuple(r[c] for c in INCIDENTS.names) for r in full], _nullable(INCIDENTS))

    return build
