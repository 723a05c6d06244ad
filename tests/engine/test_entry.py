"""The entry module: names, SQL keys, and life without the optional subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 70


def test_works_without_the_optional_subpackage(tmp_path):
    shutil.copytree(f"{ROOT}/metalake", tmp_path / "metalake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'mapping_stats' in q and 'pipeline' not in q and not any(k.startswith('op1_') for k in q)"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)


def test_broken_imports_are_not_swallowed(tmp_path):
    shutil.copytree(f"{ROOT}/metalake", tmp_path / "metalake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module\n")
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    assert subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, env=env, capture_output=True).returncode != 0


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 1
