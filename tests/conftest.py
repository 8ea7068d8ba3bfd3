import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, 'tests'))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tideline.session import local_session

    s = local_session("*", app="tideline-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def envelopes(spark):
    """Build an envelope frame from tuples (ackId, messageId, publishTime, data, attributes)."""
    from tideline.sources.schema import ENVELOPE

    def make(rows):
        full = []
        for i, r in enumerate(rows):
            r = dict(r)
            full.append(
                (
                    r.get("ackId", f"a{i}"),
                    r.get("messageId", f"m{i}"),
                    r.get("publishTime", "2024-01-10T00:00:00.000000Z"),
                    r.get("data"),
                    r.get("attributes"),
                )
            )
        return spark.createDataFrame(full, ENVELOPE)

    return make
