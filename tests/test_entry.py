"""Driver contract of __spark_entry__.py."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_flagship(spark):
    mod = load_entry()
    df = mod.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["id_ciudad", "mes", "tmax", "tmin", "tavg"]


def test_oracle_keys_are_queries():
    mod = load_entry()
    q, o = mod.queries(), mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80 and len(o) >= 60
