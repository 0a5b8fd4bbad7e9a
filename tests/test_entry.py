"""The driver's entry without the training-data folders."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _names(folder, extra=""):
    code = f"{extra}\nimport __spark_entry__ as e\nprint(*e.queries())\nassert set(e.oracle_sql()) <= set(e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True,
                          env={**os.environ, "PYTHONPATH": ""})
    return set(done.stdout.split())


def _copy(folder, skip=()):
    keep = shutil.ignore_patterns("__pycache__", "*.pyc", *skip)
    shutil.copytree(f"{ROOT}/ledgerloom", f"{folder}/ledgerloom", ignore=keep)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", folder)


def test_entry_without_the_training_data_folder(tmp_path):
    _copy(tmp_path, ["llm"])
    assert _names(tmp_path) == set(entry._load())
    if os.path.exists(tmp_path / "corpus_pipeline.py"):
        os.remove(tmp_path / "corpus_pipeline.py")
        assert _names(tmp_path) == set(entry._load())


def test_entry_without_the_tokenizers(tmp_path):
    """Finance queries need nothing that only the training-data operators import."""
    _copy(tmp_path)
    assert _names(tmp_path, "import sys; sys.modules['public_tokenizers'] = None") == set(entry._load())
