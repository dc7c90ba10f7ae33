"""The entry module loads without a session, a jar or any other file of Spark."""

import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.ml.feature import StopWordsRemover

from postlens.functions.stop_words import ENGLISH

ROOT = Path(__file__).resolve().parents[1]


def test_entry_imports_in_a_fresh_process_without_jars(tmp_path):
    code = (
        "import pathlib, zipfile\n"
        "def refuse(*args, **kwargs): raise AssertionError('a jar is read')\n"
        "import pyspark.ml, pyspark.sql\n"
        f"pyspark.__path__.insert(0, {str(tmp_path)!r})\n"
        "pathlib.Path.glob = zipfile.ZipFile = refuse\n"
        "import __spark_entry__ as e\n"
        "from pyspark.sql import SparkSession\n"
        "assert SparkSession.getActiveSession() is None\n"
        "assert set(e.oracle_sql()) <= set(e.queries())\n"
        "print(len(e.queries()))\n"
    )
    said = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert said.returncode == 0, said.stderr
    assert int(said.stdout.split()[-1]) > 100


def test_stop_words_are_those_of_spark(spark):
    assert StopWordsRemover.loadDefaultStopWords("english") == ENGLISH


def test_entry_loads_without_the_text_preparation_part(tmp_path):
    shutil.copytree(ROOT / "postlens", tmp_path / "postlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op') or n == 'pipeline' for n in e.queries()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert said.returncode == 0, said.stderr
    every, optional = map(int, said.stdout.split()[-2:])
    assert every > 100 and optional == 0


def third_party():
    """The packages that modules of the optional part import at their top, besides those the rest needs too."""
    found = set()
    for path in [*(ROOT / "postlens" / "llm").glob("*.py"), ROOT / "corpus_pipeline.py"]:
        if path.exists():
            found |= set(re.findall(r"^(?:import|from) (\w+)", path.read_text(), re.M))
    return sorted(found - set(sys.stdlib_module_names) - {"postlens", "pyspark", "__future__"})


@pytest.mark.parametrize("package", third_party())
def test_entry_loads_without_a_package_of_the_optional_part(package):
    if package in ("numpy", "pyarrow"):
        pytest.skip("Spark's own Python functions need it")
    code = (
        "import sys, builtins\n"
        "real = builtins.__import__\n"
        "def hidden(name, *args, **kwargs):\n"
        f"    if name.split('.')[0] == {package!r}: raise ModuleNotFoundError(f'No module named {{name!r}}', name=name)\n"
        "    return real(name, *args, **kwargs)\n"
        "builtins.__import__ = hidden\n"
        "import __spark_entry__ as e\n"
        "print(len(e.queries()), sum(n == 'pipeline' or (n.startswith('op') and n[2].isdigit()) for n in {**e.queries(), **e.oracle_sql()}))\n"
    )
    said = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert said.returncode == 0, said.stderr
    every, optional = map(int, said.stdout.split()[-2:])
    assert every > 100 and optional == 0 and package in said.stderr
