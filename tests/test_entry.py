import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent
SAYS = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert not set(s) - set(q); print(len(q), any(n.startswith('op') or n == 'pipeline' for n in q))"


def run(at, code):
    return subprocess.run([sys.executable, "-c", code], cwd=at, capture_output=True, text=True, timeout=120)


def test_without_the_subpackage(tmp_path):
    shutil.copytree(REPO / "textloom", tmp_path / "textloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    r = run(tmp_path, SAYS)
    assert r.returncode == 0 and r.stdout.endswith("False\n"), r.stderr


def test_a_missing_package_of_the_subpackage_is_told(tmp_path):
    (tmp_path / "textloom" / "llm").mkdir(parents=True)
    shutil.copytree(REPO / "textloom", tmp_path / "textloom", ignore=shutil.ignore_patterns("llm", "__pycache__"), dirs_exist_ok=True)
    (tmp_path / "textloom" / "llm" / "__init__.py").write_text("import no_such_module_here\n")
    (tmp_path / "corpus_pipeline.py").write_text("import textloom.llm\n")
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    r = run(tmp_path, SAYS)
    assert r.returncode == 0 and r.stdout.endswith("False\n") and "no_such_module_here" in r.stderr


def test_nothing_else_imports_it():
    for p in (REPO / "textloom").rglob("*.py"):
        if "llm" not in p.parts:
            assert "llm" not in [w for line in p.read_text().splitlines() if line.lstrip().startswith(("import ", "from ")) for w in line.replace(".", " ").split()], p
