"""The entry point: names match, SQL belongs to queries, and all works without the text-pipeline operators."""

import os
import shutil
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_every_oracle_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 120 and len(entry.oracle_sql()) > 110


def test_without_text_operators(tmp_path):
    for name in ("spectraloom", "__spark_entry__.py"):
        source = os.path.join(HERE, name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q); print('fine')"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert "fine" in done.stdout, done.stderr
