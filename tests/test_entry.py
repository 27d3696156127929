"""The driver's entry without the optional subpackage, or with one that fails to import."""

import subprocess
import sys

import pytest

from conftest import ROOT

SCRIPT = """
import sys, warnings
sys.path.insert(0, {root!r})
for name in {missing!r}:
    sys.modules[name] = None
warnings.simplefilter("error" if {quiet!r} else "ignore")
import __spark_entry__ as entry
from goldleaf.plans import catalog
assert set(entry.queries()) >= set(catalog.QUERIES) and set(entry.oracle_sql()) >= set(catalog.ORACLE)
assert "pipeline" not in entry.queries() and not any(n.startswith("op") for n in entry.queries())
"""


@pytest.mark.parametrize(("missing", "quiet"), [(["goldleaf.llm", "corpus_pipeline"], True), (["public_tokenizers"], False)])
def test_core_queries_do_not_need_the_optional_modules(missing, quiet):
    subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT, missing=missing, quiet=quiet)], check=True, timeout=120)
