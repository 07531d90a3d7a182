import subprocess
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

ROOT = Path(__file__).resolve().parent.parent


def test_entry_points_load_without_a_session():
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q) and len(q) > 70; print('ok')"
    assert "ok" in subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120).stdout


def test_core_does_not_import_llm():
    for f in (ROOT / "corpusloom").rglob("*.py"):
        if "llm" not in f.relative_to(ROOT).parts:
            assert "corpusloom.llm" not in f.read_text() and "from . import llm" not in f.read_text(), f


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["src", "rec_id", "normal"] and df.count() > 0


def rows(frame):
    def one(v):
        if v is None or v is pd.NA or v != v:
            return "NULL"
        if isinstance(v, float) or type(v).__name__ in ("Decimal", "float64"):
            return f"{float(v):.8g}"
        return str(int(v)) if isinstance(v, bool) or type(v).__name__.startswith(("int", "bool")) else str(v)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(one(v) for v in r) for r in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for f in Path(data).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from read_parquet('{f}{'/*.parquet' if f.is_dir() else ''}')")
    return con


def _names():
    from corpusloom.plans import catalog

    return sorted(catalog.sql())


@pytest.mark.parametrize("name", _names())
def test_queries_equal_sql(spark, data, duck, name):
    from corpusloom.plans import catalog

    assert rows(catalog.queries()[name](spark, data).toPandas()) == rows(duck.execute(catalog.sql()[name]).df())
