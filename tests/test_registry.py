import os
import subprocess
import sys

import __spark_entry__ as entry


def test_every_oracle_belongs_to_a_query():
    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert len(entry.queries()) > 80


def test_errors_of_the_corpus_operators_are_told(tmp_path):
    """Only their absence is passed over."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name in ("larkspire", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", f"{root}/{name}", str(tmp_path)], check=True)
    (tmp_path / "corpus_pipeline.py").write_text("import a_module_that_nobody_has")
    os.makedirs(tmp_path / "larkspire" / "llm", exist_ok=True)
    (tmp_path / "larkspire" / "llm" / "__init__.py").touch()
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert said.returncode and "a_module_that_nobody_has" in said.stderr


def test_imports_without_corpus_operators(tmp_path):
    """The rest works where the corpus operators are absent."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name in ("larkspire", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", f"{root}/{name}", str(tmp_path)], check=True)
    subprocess.run(["rm", "-rf", str(tmp_path / "larkspire" / "llm")], check=True)
    code = "import __spark_entry__ as e; print(len(e.queries()), not any(k.startswith('op') and k[2].isdigit() or k == 'pipeline' for k in e.queries()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""}, check=True)
    assert said.stdout.split()[-1] == "True" and int(said.stdout.split()[0]) > 80
