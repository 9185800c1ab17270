"""The entry points on copies of the library, in processes of their own."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(code, folder, **env):
    keep = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", code], cwd=folder, env=keep | env, capture_output=True, text=True, timeout=300)


def test_entry_without_the_document_operators(tmp_path):
    """With the operators over documents deleted, the pipeline's file left or not, the other queries are there."""
    copy = tmp_path / "copy"
    shutil.copytree(os.path.join(REPO, "revflow"), copy / "revflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(REPO, "__spark_entry__.py"), copy)
    code = "import __spark_entry__ as e; a, b = e.queries(), e.oracle_sql(); assert set(a) == set(b) and len(a) > 60 and 'pipeline' not in a"
    for pipeline in (False, True):
        if pipeline:
            (copy / "corpus_pipeline.py").write_text("from revflow.llm import quality\n")
        done = _run(code, copy)
        assert done.returncode == 0, done.stderr


def test_workers_get_the_package(tmp_path):
    """A job whose functions come from the package runs from a folder in which workers cannot import it."""
    code = f"""
import sys
sys.path.insert(0, {REPO!r})
from revflow.session import build_session, ship
spark = build_session(master="local[2]")
ship(spark); ship(spark)

def run(batches):
    import revflow.functions.names as there
    for b in batches:
        yield b.assign(name=[there.snake_name(x) for x in b["name"]])
df = spark.createDataFrame([("A b",)], "name string").mapInPandas(run, "name string")
assert df.collect()[0][0] == "a_b", df.collect()
spark.stop()
"""
    done = _run(code, tmp_path, HOME=str(tmp_path))
    assert done.returncode == 0, done.stderr[-2000:]
