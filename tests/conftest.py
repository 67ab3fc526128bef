import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from chunkwright.session import session

    s = session("tests", "local[4]", 4, spark__driver__memory="4g", spark__ui__showConsoleProgress="false", spark__driver__host="127.0.0.1")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for p in Path(SMALL).glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS FROM '{p}'")
    return c
