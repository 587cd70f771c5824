"""The registered queries outside the text operators need neither their package nor the pipeline module."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

_RUN = """
import sys
import __spark_entry__ as entry
from basketlens.session import local_session
names = entry.queries()
assert not any(name.startswith("op") or name == "pipeline" for name in names), sorted(names)
spark = local_session(2, shuffle_partitions=2, driver_memory="1g")
assert names["d11_rfm_features"](spark, sys.argv[1]).count() > 0
"""


def _copy(tmp_path, *left_out):
    copy = tmp_path / "copy"
    gone = shutil.ignore_patterns("llm", "__pycache__", ".git", "*.json", *left_out)
    shutil.copytree(ROOT, copy, ignore=gone)
    return copy


def _run(copy, folder):
    found = subprocess.run([sys.executable, "-c", _RUN, folder], cwd=copy, capture_output=True, text=True, timeout=300)
    assert found.returncode == 0, found.stderr[-2000:]


def test_without_the_text_folders(tmp_path, folder):
    _run(_copy(tmp_path), folder)


def test_without_the_text_folders_and_the_pipeline(tmp_path, folder):
    _run(_copy(tmp_path, "corpus_pipeline.py"), folder)
