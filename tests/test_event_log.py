"""Shuffle totals of a real run, read from the log that run wrote."""

import os
import subprocess
import sys

from millrace.sources.event_log import shuffle_totals

APP = """
import sys
from millrace.operators.sessions import average_session_duration
from millrace.session import build_session
from millrace.sources.generators import id_range, session_log

spark = build_session("logged", "local[2]", **{
    "spark.eventLog.enabled": "true", "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false", "spark.eventLog.dir": sys.argv[1],
    "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false",
})
logs = session_log(id_range(spark, 2000)).persist()
logs.count()
for layout in ("default", "round_robin"):
    spark.sparkContext.setJobGroup(layout, layout)
    average_session_duration(logs, layout, 8).collect()
spark.stop()
"""


def test_shuffle_totals(spark, tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run(
        [sys.executable, "-c", APP, str(tmp_path)], check=True, timeout=300,
        env=os.environ | {"PYTHONPATH": root}, capture_output=True,
    )
    found = {r["job_group"]: r for r in shuffle_totals(spark, str(tmp_path)).collect()}
    assert set(found) == {"default", "round_robin"}
    default, moved = found["default"], found["round_robin"]
    assert default["write_mb"] > 0 and default["read_mb"] > 0 and default["tasks"] > 0
    assert moved["write_mb"] > 1.2 * default["write_mb"]
    assert moved["write_records"] > default["write_records"]
    assert moved["stages"] > default["stages"]
