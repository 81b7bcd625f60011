"""The registered queries of the llm operators: SQL twins, names, and the import guard."""

import subprocess
import sys

import pytest

import __spark_entry__ as registry
import parity
from civicloom.llm import queries


def test_names():
    assert {name.split("_")[0] for name in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(registry.queries())


@pytest.mark.parametrize("name", list(queries.SQL))
def test_twin(spark, sf, name):
    state, note = parity.compare(spark, parity.duck(sf), name, sf)
    assert state == "ok", note


def test_the_rest_imports_without_llm():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('corpus_pipeline', 'civicloom.llm'):\n"
        "            raise ModuleNotFoundError(name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and not any(k.startswith('op') or k == 'pipeline' for k in e.queries())\n"
        "assert not any(m.startswith('civicloom.llm') for m in sys.modules)\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=registry.__file__.rsplit("/", 1)[0])
