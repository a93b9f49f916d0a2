"""The entry offers what can be imported, whatever is missing."""

import subprocess
import sys
from pathlib import Path

import pytest

SCRIPT = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name == sys.argv[1] or name.startswith(sys.argv[1] + "."):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
names = entry.queries()
print(len([n for n in names if not n.startswith("op") and n != "pipeline"]), "silver_cast" in names,
      any(n.startswith("op") for n in names), set(entry.oracle_sql()) <= set(names))
"""


@pytest.mark.parametrize("missing", ["silverlake.llm", "xxhash", "corpus_pipeline", "tokenizers"])
def test_entry_without_a_part(missing):
    repo = Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-c", SCRIPT, missing], cwd=repo, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    count, first, numbered, twins = done.stdout.split()
    assert int(count) >= 57 and first == twins == "True"
    if missing != "corpus_pipeline":
        assert numbered == "False" or missing == "tokenizers"
