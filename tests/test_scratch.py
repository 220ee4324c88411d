"""Intermediate tables live as long as the driver process."""

import os
import subprocess
import sys

import pytest

from martlens.session import is_local

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
from martlens.session import local_session, scratch_folder
spark = local_session(1)
spark.conf.set("spark.sql.shuffle.partitions", "1")
spark.sparkContext.setCheckpointDir(sys.argv[1])
path = scratch_folder(spark, "t")
df = spark.range(5)
df.write.parquet(path + "/rows")
assert spark.read.parquet(path + "/rows").count() == 5
print("PATH", path)
{end}
"""


@pytest.mark.parametrize("end", ["", "spark.stop()"])
def test_scratch_folders_go_when_the_driver_ends(tmp_path, end):
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(end=end), str(tmp_path)], cwd=ROOT, capture_output=True, text=True,
                         timeout=200, check=True)
    path = [x for x in run.stdout.splitlines() if x.startswith("PATH")][0].split()[1].removeprefix("file:")
    if not end:
        assert not os.path.exists(path)


def test_only_masters_in_one_process_are_local():
    assert is_local("local") and is_local("local[8]") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")
