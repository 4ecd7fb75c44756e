import os
import pathlib
import shutil
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_entry_without_the_training_data_operators(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT / "roadpulse", copy / "roadpulse", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", copy)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'map_match' in q and not [n for n in q if n.startswith('op')]; e.oracle_sql()"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)},
                          capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]


def test_nothing_else_imports_the_subpackage():
    for path in ROOT.glob("roadpulse/**/*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "roadpulse.llm" not in path.read_text(), path
