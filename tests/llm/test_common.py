import os
import subprocess
import sys

import pytest

ONE = """
import sys
sys.path.insert(0, {repo!r})
from sideline.session import build_session
spark = build_session("local[2]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {folder!r}}})
from sideline.llm.common import table
assert table(spark.range(5), "x").count() == 5
{last}
"""


@pytest.mark.parametrize("last", ["", "spark.stop()"])
def test_written_tables_go_when_the_driver_ends(tmp_path, last):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = ONE.format(repo=repo, folder=str(tmp_path), last=last)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-1500:]
    assert not [f for f in os.listdir(tmp_path) if f.startswith("llm-")]
