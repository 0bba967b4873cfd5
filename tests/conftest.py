import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from reviewlab.session import local_session
    s = local_session("4", shuffle_partitions=8, app="reviewlab-tests", driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from reviewlab.sources.tables import TABLES

    def make(sf_dir):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        return con
    return make
