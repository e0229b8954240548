"""Every registered query against its SQL oracle."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    frame = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert differences(frame, con, ORACLES[name]) == []
    else:
        assert frame.count() > 0


def test_entry(spark):
    assert entry(spark).count() == 15


def test_a_missing_part_leaves_the_rest():
    """Without a package that the optional operators need, the other queries still load."""
    code = (
        "import sys; sys.modules['public_tokenizers'] = None;"
        "import __spark_entry__ as e; names = set(e.queries());"
        "assert len(names) > 100 and not any(n.startswith('op') for n in names), names;"
        "assert set(e.oracle_sql()) <= names"
    )
    root = Path(__file__).resolve().parent.parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
