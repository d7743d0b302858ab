"""The engine stands alone: without the optional operators its queries are all there."""

import shutil
import subprocess
import sys

import pytest

from conftest import ROOT
from tidemark.plans import registry


@pytest.mark.parametrize("leave", [(), ("__pycache__",)])
def test_without_optional_operators(tmp_path, leave):
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{ROOT}/tidemark", tmp_path / "tidemark", ignore=lambda folder, names: [n for n in names if n not in leave] if folder.endswith("/llm") else [])
    if not leave:
        shutil.rmtree(tmp_path / "tidemark" / "llm")
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "", "PYTHONPATH": str(tmp_path)})
    assert out.stdout.splitlines() == [" ".join(sorted(registry.queries())), " ".join(sorted(registry.oracle_sql()))], out.stderr
