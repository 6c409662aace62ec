"""The driver contract holds in a copy of the tree that has no text operators."""

import os
import shutil
import subprocess
import sys

from spanlake.plans.catalog import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

COUNT = """
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), "pipeline" in e.queries())
"""


def counted(folder) -> str:
    made = subprocess.run(
        [sys.executable, "-c", COUNT],
        cwd=folder,
        env={**os.environ, "PYTHONPATH": str(folder)},
        capture_output=True,
        text=True,
        check=True,
    )
    return made.stdout.split("\n")[-2]


def copied(folder, *left_out: str):
    shutil.copytree(f"{ROOT}/spanlake", folder / "spanlake", ignore=shutil.ignore_patterns(*left_out))
    for file in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(f"{ROOT}/{file}") and file not in left_out:
            shutil.copy(f"{ROOT}/{file}", folder / file)
    return folder


def test_without_text_operators(tmp_path):
    number = len(QUERIES)
    assert counted(copied(tmp_path / "a", "llm")) == f"{number} {number} False"
    assert counted(copied(tmp_path / "b", "llm", "corpus_pipeline.py")) == f"{number} {number} False"


def test_an_emptied_folder_is_no_package(tmp_path):
    folder = copied(tmp_path / "c", "llm")
    (folder / "spanlake" / "llm").mkdir()
    assert counted(folder).endswith("False")
