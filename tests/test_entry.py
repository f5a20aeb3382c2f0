"""The entry module with the separate part present, absent, left over or broken."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(*sorted(e.queries()), sep='\\n')"


def copy(to, text_part: str):
    shutil.copytree(f"{REPO}/corridor", f"{to}/corridor", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{REPO}/__spark_entry__.py", to)
    if text_part == "left over":
        os.makedirs(f"{to}/corridor/llm/__pycache__")
    if text_part in ("present", "broken"):
        os.makedirs(f"{to}/corridor/llm")
        body = "QUERIES, ORACLE_SQL = {'op0': print}, {}\n"
        broken = "from corridor.llm import no_such_module\n" * (text_part == "broken")
        for name, text in (("__init__", ""), ("queries", broken + body)):
            with open(f"{to}/corridor/llm/{name}.py", "w") as file:
                file.write(text)
        with open(f"{to}/corpus_pipeline.py", "w") as file:
            file.write("run, ORACLE_SQL = print, None\n")
    return subprocess.run([sys.executable, "-c", COUNT], cwd=to, capture_output=True, text=True)


@pytest.mark.parametrize("text_part", ["absent", "left over"])
def test_without_the_text_part(tmp_path, text_part):
    got = copy(tmp_path, text_part)
    names = got.stdout.split()
    assert got.returncode == 0, got.stderr
    assert len(names) > 50 and not any(n.startswith("op") or n == "pipeline" for n in names)


def test_with_the_text_part(tmp_path):
    names = copy(tmp_path, "present").stdout.split()
    assert {"op0", "pipeline", "gold_advisories"} <= set(names)


def test_a_broken_text_part_is_not_hidden(tmp_path):
    got = copy(tmp_path, "broken")
    assert got.returncode != 0 and "no_such_module" in got.stderr
