"""The entry works without the optional subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
import __spark_entry__ as E
q, s = E.queries(), E.oracle_sql()
assert set(s) <= set(q)
print(sorted(k for k in q if k.startswith("op") or k == "pipeline"), len(q))
import tests.oracle_compare
"""


def _copy(tmp_path, *left_out):
    os.makedirs(tmp_path)
    for name in ("attrition", "tests", "__spark_entry__.py", "corpus_pipeline.py"):
        src, dst = os.path.join(ROOT, name), tmp_path / name
        if not os.path.exists(src) or name in left_out:
            continue
        if os.path.isdir(src):
            shutil.copytree(src, dst, ignore=lambda d, names: [n for n in names if n in ("__pycache__",) or os.path.join(os.path.basename(d), n) in left_out])
        else:
            shutil.copy(src, dst)
    out = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert out.returncode == 0, out.stderr
    return out.stdout.strip()


def test_entry_without_the_subpackage(tmp_path):
    assert _copy(tmp_path / "a", "attrition/llm", "tests/llm").startswith("[] ")


def test_entry_without_the_subpackage_and_the_pipeline(tmp_path):
    assert _copy(tmp_path / "b", "attrition/llm", "tests/llm", "corpus_pipeline.py").startswith("[] ")
