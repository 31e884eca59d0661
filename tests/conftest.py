import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = sys.path[0] + os.pathsep + os.environ.get("PYTHONPATH", "")

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from corpusforge.session import build

    s = build("local[4]", 4, **{"spark.driver.memory": "4g", "spark.checkpoint.dir": tempfile.mkdtemp(), "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in sorted(os.listdir(SMALL)):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS FROM '{SMALL}/{f}'")
    return con


def rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_plain(r[c]) for c in cols) for r in df.collect()), key=_key)


def oracle_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    return cols, sorted((tuple(_plain(r[i]) for i in at) for r in cur.fetchall()), key=_key)


def _plain(v):
    return round(v, 9) if isinstance(v, float) else v


def _key(r):
    return [(v is None, str(v)) for v in r]
