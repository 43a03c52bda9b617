"""The driver's entry module, with and without the corpus folders."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
ASK = """
import re, __spark_entry__ as e
names = list(e.queries())
print(len(names), sum(bool(re.match(r"op[0-9]+_|pipeline$", n)) for n in names))
"""


def _asked(folder: Path) -> tuple[int, int]:
    done = subprocess.run([sys.executable, "-c", ASK], cwd=folder, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    all_of_them, corpus = map(int, done.stdout.split())
    return all_of_them, corpus


@pytest.mark.parametrize("left_out", [["siltstone/llm", "corpus_pipeline.py"], ["siltstone/llm"]])
def test_without_the_corpus_folder(tmp_path, left_out):
    """The other queries stay registered; ``corpus_pipeline`` may be there without its operators."""
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in left_out and (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    shutil.copytree(ROOT / "siltstone", tmp_path / "siltstone", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    all_of_them, corpus = _asked(tmp_path)
    assert all_of_them > 50
    assert corpus == 0


def test_every_oracle_has_a_query():
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
