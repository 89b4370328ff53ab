"""The entry point with and without the training-data operators, and sessions without a shared folder."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

WITHOUT = """
import importlib.abc, sys
class Missing(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {top!r} or name == {top!r} or name.startswith({top!r} + "."):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
names = set(entry.queries())
assert "top10_similar" in names and set(entry.oracle_sql()) <= names, names
assert not any(n.startswith("op") and "_" in n and n[2].isdigit() for n in names) and "pipeline" not in names
"""


def run(code, **env):
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300, env={**os.environ, **env}
    )
    assert done.returncode == 0, done.stderr[-2000:]


def test_entry_without_the_training_data_operators():
    for top in ("paperloom.llm", "corpus_pipeline", "public_tokenizers"):
        run(WITHOUT.format(top=top))


def test_a_session_without_a_checkpoint_folder_can_write_intermediates(tmp_path):
    code = (
        "from paperloom.session import local_session, materialise, shared_folder\n"
        "spark = local_session(2)\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "assert materialise(spark.range(5), 'x').count() == 5 and shared_folder(spark) == shared_folder(spark)\n"
    )
    run(code, SPARK_CONF_DIR=str(tmp_path))
