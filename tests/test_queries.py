"""Every registered query beside its SQL, rows compared."""

import pytest
from oracles import compare

from tidemill.plans import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, sf, name):
    assert compare(spark, name, registry.queries()[name], registry.oracle_sql()[name], sf) > 0


def test_the_optional_part_is_optional(tmp_path):
    """In a copy without the folders and the pipeline the rest imports and its queries stand."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "tidemill", tmp_path / "tidemill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and len(q) > 60 and not any(k.startswith('op') and k[2].isdigit() for k in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path, env={k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"})
