"""The driver contract where the optional operators cannot be imported."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]

BLOCKED = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Blocked())
sys.path.insert(0, {root!r})
import __spark_entry__ as driver
names = driver.queries()
print(len(names), "company_address" in names, any(n == "pipeline" or n[:2] == "op" and n[2].isdigit() for n in names))
"""


@pytest.mark.parametrize("name", ["triplewright.llm", "corpus_pipeline", "public_tokenizers"])
def test_core_queries_work_without_the_optional_part(name):
    code = BLOCKED.format(name=name, root=str(ROOT))
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    n, core, optional = done.stdout.split()
    assert int(n) >= 66 and core == "True" and optional == "False"


def test_an_empty_folder_in_place_of_the_optional_part(tmp_path):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "triplewright_checks").symlink_to(ROOT / "triplewright_checks")
    package = tmp_path / "triplewright"
    (package / "llm/__pycache__").mkdir(parents=True)
    for part in (ROOT / "triplewright").iterdir():
        if part.name not in ("llm", "__pycache__"):
            (package / part.name).symlink_to(part)
    code = f"import sys; sys.path.insert(0, {str(tmp_path)!r}); import __spark_entry__ as d; print(len(d.queries()))"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=tmp_path)
    assert int(done.stdout) >= 66
