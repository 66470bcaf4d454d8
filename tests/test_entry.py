"""The sales queries stand on their own: a copy without the operators for training data gives them all."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from checks.registry import QUERIES

ROOT = Path(__file__).parents[1]
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"


def copy_of(folder, *left_out):
    to = Path(folder) / "copy"
    for name in ("saleslake", "checks", "tests"):
        shutil.copytree(ROOT / name, to / name, ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, to / name)
    for name in left_out:
        if (to / name).is_dir():
            shutil.rmtree(to / name)
        else:
            (to / name).unlink(missing_ok=True)
    return to


def run(copy, *command):
    return subprocess.run([sys.executable, *command], cwd=copy, capture_output=True, text=True, timeout=300)


@pytest.mark.parametrize(
    "left_out",
    [("saleslake/llm", "tests/llm"), ("saleslake/llm", "tests/llm", "corpus_pipeline.py")],
    ids=["folders", "folders and pipeline"],
)
def test_a_copy_without_the_other_operators(folder, left_out):
    copy = copy_of(folder, *left_out)
    assert run(copy, "-c", COUNT).stdout.split() == [str(len(QUERIES))] * 2
    collected = run(copy, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider")
    assert collected.returncode == 0, collected.stdout


def test_an_operator_that_cannot_be_imported_costs_no_sales_query(folder):
    copy = copy_of(folder)
    broken = copy / "saleslake" / "llm"
    broken.mkdir(exist_ok=True)
    (broken / "__init__.py").touch()
    (broken / "queries.py").write_text("import a_library_that_is_not_there\n")
    assert run(copy, "-c", COUNT).stdout.split() == [str(len(QUERIES))] * 2
