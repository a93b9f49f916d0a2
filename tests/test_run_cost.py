"""What a run reads and writes, from Spark's event log."""

import json
import subprocess
import sys
from pathlib import Path

ROWS = 20_000

SCRIPT = """
import sys
from pyspark.sql import SparkSession, functions as F
from silverlake.plans.daily import run_day
from silverlake.plans.specs import find

root, rows = sys.argv[1], int(sys.argv[2])
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", root + "/shared")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://" + root + "/events")
    .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false").getOrCreate()
)
lists = F.when(F.col("id") % 5 == 0, '[{"id": 1').otherwise('[{"id": 1, "name": "a"}, {"id": "x", "name": "b"}]')
spark.sparkContext.setJobDescription("before")
bronze = spark.range(rows).select(F.col("id"), lists.alias("genres"))
bronze.write.parquet(root + "/bronze/movies/movies_part_20221104-120000.parquet")
spark.sparkContext.setJobDescription(None)
log = run_day(spark, root + "/bronze", root + "/silver", 20221104, tables={"genres": find("genres")}).first()
print("LOG", log["status"], log["rows_in"], log["rows_written"], log["lost"]["unreadable"], log["lost"]["bad_elements"])
spark.stop()
"""


def test_one_pass_counts_and_writes(tmp_path):
    (tmp_path / "events").mkdir()
    repo = Path(__file__).resolve().parent.parent
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(tmp_path), str(ROWS)], cwd=repo, capture_output=True, text=True, timeout=300
    )
    found = [line.split()[1:] for line in done.stdout.splitlines() if line.startswith("LOG")]
    # Every fifth list is cut off and gives one row; the others give two, of which one has a bad id.
    assert found == [["written", str(ROWS), str(ROWS // 5 + ROWS // 5 * 4 * 2), str(ROWS // 5), str(ROWS // 5 * 4)]], done.stderr[-2000:]

    events = [json.loads(line) for path in (tmp_path / "events").iterdir() for line in path.read_text().splitlines()]
    stages = {
        stage
        for e in events
        # The run's threads have no description.
        if e["Event"] == "SparkListenerJobStart" and e.get("Properties", {}).get("spark.job.description") != "before"
        for stage in e["Stage IDs"]
    }
    tasks = [e for e in events if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stages]
    read = sum(t["Task Metrics"]["Input Metrics"]["Records Read"] for t in tasks)
    written = sum(t["Task Metrics"]["Output Metrics"]["Records Written"] for t in tasks)
    files = len(list((tmp_path / "bronze").rglob("*.parquet"))) - 1  # without the folder
    # Objects are listed, each bronze row is read once, and each silver row is written once; the log has one row more.
    assert read == ROWS + files
    assert written == ROWS // 5 * 9 + 1
