import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_imports_without_llm(tmp_path):
    for name in ("heddle", "__spark_entry__.py"):
        source = os.path.join(ROOT, name)
        shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__")) if os.path.isdir(source) else shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pricing_summary' in q and not any(n.startswith('op1_') for n in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


def test_imports_without_a_library(tmp_path):
    for name in ("heddle", "__spark_entry__.py", "corpus_pipeline.py"):
        source = os.path.join(ROOT, name)
        if not os.path.exists(source):
            return
        shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__")) if os.path.isdir(source) else shutil.copy(source, tmp_path / name)
    code = "import sys; sys.modules['zstandard'] = sys.modules['ahocorasick'] = None; import __spark_entry__ as e; assert 'pricing_summary' in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})


def test_entry_runs(spark):
    import __spark_entry__

    if os.path.isdir("/root/testdata/sf0.001"):
        assert __spark_entry__.entry(spark).count() > 0
