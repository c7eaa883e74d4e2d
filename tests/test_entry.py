"""The driver contract: entry, queries and oracle names line up."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as E


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["o_orderkey", "class_idx", "raw"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_without_the_training_data_part(tmp_path):
    """The other queries import and are listed when that subpackage and its pipeline are gone."""
    root = os.path.dirname(os.path.abspath(E.__file__))
    for name in ("__spark_entry__.py",):
        shutil.copy(os.path.join(root, name), tmp_path)
    shutil.copytree(os.path.join(root, "sylva"), tmp_path / "sylva", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as E; print(sorted(E.queries()) == sorted(q for q in E.queries() if not q.startswith('op') and q != 'pipeline'), len(E.queries()), set(E.oracle_sql()) <= set(E.queries()))"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert got.stdout.split()[0] == "True" and int(got.stdout.split()[1]) >= 38 and got.stdout.split()[2] == "True", got.stderr
