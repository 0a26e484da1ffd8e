import pytest

from faresettle.session import drop_scratch, local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4)
    yield session
    drop_scratch(session)


@pytest.fixture()
def table(spark):
    """A fresh managed table of report rows in the shared folder."""
    from faresettle.catalog.queries import scratch_table
    from faresettle.plans.contract import REPORT_SCHEMA

    return scratch_table(spark, REPORT_SCHEMA)
