"""The training-data part can be removed, and nothing else leans on it."""

import pathlib
import shutil
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_nothing_else_imports_the_training_data_part():
    for path in (ROOT / "tracewell").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT / "tracewell").parts:
            assert "llm" not in path.read_text(), path


def test_entry_works_without_it(tmp_path):
    shutil.copytree(ROOT / "tracewell", tmp_path / "tracewell", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and set(e.oracle_sql()) <= set(q) and not [n for n in q if n.startswith('op') or n == 'pipeline']; print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
