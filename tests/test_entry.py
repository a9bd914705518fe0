"""The entry module without parts of what it offers."""

import subprocess
import sys

import pytest

PROBE = """
import sys
sys.modules[{blocked!r}] = None
import __spark_entry__ as entry
names = set(entry.queries())
print("dau_by_hour" in names, "op10_byte_bpe" in names, set(entry.oracle_sql()) <= names)
"""


@pytest.mark.parametrize("blocked", ["ahocorasick", "tillstream.llm", "tokenizers"])
def test_warehouse_queries_need_no_training_data_operators(blocked):
    """As with a missing dependency, or with the subpackage gone and the pipeline's file left."""
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", PROBE.format(blocked=blocked)],
                          capture_output=True, text=True, timeout=120, check=True)
    assert done.stdout.split()[-3:] == ["True", "False", "True"]
