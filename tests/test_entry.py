import __spark_entry__ as entry


def test_names_agree():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    assert len(queries) > 90


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 1


def test_imports_without_the_training_data_modules(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(entry.__file__).parent
    shutil.copytree(root / "voxlake", tmp_path / "voxlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); assert 'vi_split' in q and not any(x.startswith('op') for x in q); print(len(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, timeout=120)
    assert said.returncode == 0, said.stderr
