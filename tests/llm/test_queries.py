"""The registered corpus queries: against their SQL where they have one, and as the driver finds them."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from compare import connect, difference  # noqa: E402
from tidegauge.llm.queries import ORACLES, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def engine():
    connection = connect(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, engine, name):
    assert difference(QUERIES[name](spark, FOLDER), engine, ORACLES[name]) is None


def test_every_operator_has_one_query():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_nothing_else_imports_the_package():
    root = Path(__file__).resolve().parents[2]
    for path in (root / "tidegauge").rglob("*.py"):
        if "llm" not in path.parts:
            assert "tidegauge.llm" not in path.read_text()
    for path in (root / "tests").glob("*.py"):
        assert "llm" not in path.read_text()


def test_no_local_checkpoints_and_no_folders_of_one_machine():
    root = Path(__file__).resolve().parents[2]
    for path in [*(root / "tidegauge" / "llm").glob("*.py"), root / "corpus_pipeline.py"]:
        text = path.read_text()
        assert "localCheckpoint" not in text and "/tmp" not in text and "tempfile" not in text
