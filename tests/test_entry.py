import __spark_entry__ as entry_mod


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["dep_hour_local", "dow", "mean_pos_delay", "n"]


def test_every_oracle_key_is_a_query():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 66 and len(o) >= 61
    # the optional subpackage tests its own queries
    optional = {k for k in q if k == "pipeline" or (k.startswith("op") and k[2:3].isdigit())}
    rows_only = set(q) - set(o) - optional
    assert rows_only == {"ridge_metrics", "predictions", "elastic_net_metrics", "gbt_metrics",
                         "metrics_comparison"}


def test_entry_without_the_optional_subpackage():
    import os
    import subprocess
    import sys
    code = """
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("tarmac.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as e
assert len(e.queries()) >= 66 and set(e.oracle_sql()) <= set(e.queries())
assert not any(k == "pipeline" or k[:3] in ("op1", "op5") for k in e.queries())
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.abspath(entry_mod.__file__)))
