"""Every registered query runs at the smallest scale and agrees with its oracle."""

import pathlib
import subprocess
import sys

import pytest
from check_oracles import compare, connect

from larkspur.catalog import ENTRIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_query(spark, duck, name):
    entry = ENTRIES[name]
    frame = entry.run(spark, FOLDER)
    if entry.sql is None:
        assert frame.count() >= 1
    else:
        problem, _ = compare(frame, duck, entry.sql)
        assert problem is None, problem


def test_entry_points(spark):
    import __spark_entry__ as entry_points

    assert entry_points.entry(spark).columns == ["event_type", "date", "close", "daily_return", "zscore"]
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


_WITHOUT = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name in {hidden}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
print(len(entry.queries()), any(q.startswith("op") and q[2].isdigit() for q in entry.queries()), "pipeline" in entry.queries())
"""


@pytest.mark.parametrize("hidden", ["{'larkspur.llm'}", "{'larkspur.llm', 'corpus_pipeline'}", "{'corpus_pipeline'}"])
def test_entry_without_the_language_model_part(hidden):
    root = pathlib.Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-c", _WITHOUT.format(hidden=hidden)], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    n, dealt, pipeline = done.stdout.split()[-3:]
    assert int(n) >= len(ENTRIES) and pipeline == "False" and (dealt == "False" or "larkspur.llm" not in hidden)


def test_other_import_errors_are_raised():
    root = pathlib.Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-c", _WITHOUT.format(hidden="{'larkspur.session'}")], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode != 0 and "larkspur.session" in done.stderr
