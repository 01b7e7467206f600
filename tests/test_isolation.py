import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_library_stands_without_the_subpackage(tmp_path):
    """With docloom/llm and corpus_pipeline.py gone the entry point imports and keeps all other queries."""
    import shutil

    shutil.copytree(os.path.join(ROOT, "docloom"), tmp_path / "docloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.split()[0]) > 80


def test_nothing_else_imports_the_subpackage():
    for folder, _, files in os.walk(os.path.join(ROOT, "docloom")):
        if os.sep + "llm" not in folder:
            for f in files:
                if f.endswith(".py"):
                    assert "docloom.llm" not in open(os.path.join(folder, f)).read(), f
