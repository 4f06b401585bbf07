"""The library without the subpackage llm: everything else still imports and registers."""

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent


def test_nothing_else_imports_it():
    for f in (REPO / "dossierlake").rglob("*.py"):
        if "llm" not in f.relative_to(REPO).parts:
            assert "dossierlake.llm" not in f.read_text(encoding="utf-8"), f


def test_entry_without_it(tmp_path):
    code = f"import sys; sys.path.insert(0, {str(REPO)!r}); sys.modules['dossierlake.llm'] = None; import __spark_entry__ as e; q = e.queries(); assert 'p2_found' in q and 'p8_ids' not in q and not set(e.oracle_sql()) - set(q)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)
