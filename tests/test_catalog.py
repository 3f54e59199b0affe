"""Every analysis against its SQL.

On the smallest data set the part prices are an exact line, and errors of the fits are rounding noise.
"""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "scripts"))

from check import compare, connect  # noqa: E402

import __spark_entry__ as entry_file  # noqa: E402
from momentloom.catalog import REGISTRY  # noqa: E402

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_analysis(spark, con, name):
    outcome = compare(spark, con, REGISTRY[name], FOLDER)
    assert outcome.startswith(("ok", "rows")), outcome


def test_entry_returns_ranked_features(spark):
    rows = entry_file.entry(spark).collect()
    assert len(rows) == 5
    assert [r["r2"] for r in rows] == sorted((r["r2"] for r in rows), reverse=True)


def test_every_sql_has_a_query():
    assert set(entry_file.oracle_sql()) <= set(entry_file.queries())
