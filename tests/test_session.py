"""The folder of written tables."""

import os
import subprocess
import sys

from brindle.session import free, materialize

SCRIPT = """
import os, sys
from brindle.session import build_session, materialize, run_dir
spark = build_session("scratch", "local[1]", **{"spark.checkpoint.dir": sys.argv[1]})
materialize(spark.range(3), "three")
assert len(os.listdir(run_dir(spark))) == 1
"""


def test_written_tables_go_with_the_program(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path)], check=True, cwd=root, timeout=120)
    assert os.listdir(tmp_path / "brindle") == []


def test_freed_tables_are_gone(spark):
    kept, gone = materialize(spark.range(3), "kept"), materialize(spark.range(4), "gone")
    (file,) = {f.rsplit("/", 1)[0].removeprefix("file://") for f in gone.inputFiles()}
    assert os.path.isdir(file)
    free(gone)
    assert not os.path.exists(file) and kept.count() == 3
