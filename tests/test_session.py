"""Intermediate tables live in the shared folder and go with the application."""

import os
import subprocess
import sys

import pytest

from meterflow.functions.scalars import financial_year_start
from meterflow.session import delete, materialize, recorded_scratch

RUN = """
import sys
from meterflow.session import build_session, materialize, scratch_root
spark = build_session(master="local[1]", **{"spark.ui.enabled": "false", "spark.checkpoint.dir": sys.argv[1]})
assert materialize(spark.range(5), "five").count() == 5
import os
assert os.listdir(scratch_root(spark))
spark.stop()
"""


def test_scratch_is_gone_after_the_session(tmp_path):
    subprocess.run([sys.executable, "-c", RUN, str(tmp_path)], check=True, env=os.environ | {"PYTHONPATH": os.getcwd()}, timeout=120)
    left = [name for _, _, names in os.walk(tmp_path) for name in names]
    assert not left


def test_recorded_scratch_can_be_deleted(spark):
    before = materialize(spark.range(3), "kept")
    with recorded_scratch() as paths:
        inside = materialize(spark.range(4), "gone")
    after = materialize(spark.range(5), "kept")
    assert len(paths) == 1 and inside.count() == 4
    delete(spark, paths[0])
    delete(spark, paths[0])
    assert not os.path.exists(paths[0]) and before.count() == 3 and after.count() == 5


def test_financial_years():
    assert financial_year_start("2025-2026") == 2025 * 12 + 3
    for wrong in ("2025", "2025-2027", "a-b"):
        with pytest.raises(ValueError):
            financial_year_start(wrong)
