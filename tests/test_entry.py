"""The entry without the optional corpus operators: every other query is still there."""

import pathlib
import shutil
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parents[1]


def test_entry_imports_without_the_corpus_operators(tmp_path):
    shutil.copytree(ROOT / "webloom", tmp_path / "webloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.oracle_sql()), len(e.queries()), any(q.startswith('op') for q in e.queries()))"
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
    same, number, corpus = got.stdout.split()
    assert (same, corpus) == ("True", "False") and int(number) >= 47
