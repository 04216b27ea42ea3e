"""Job and stage times of one registered query, from Spark's event log (no UI).

    python scripts/stage_times.py /root/testdata/sf0.1 dim_users

Runs the query once to warm up and once measured, with the event log written to a fresh
scratch folder, then prints wall time, job/stage counts, the time during which any job
was running (the rest is driver-side planning) and the slowest stages with their operators.
"""

import glob
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from dimloom.plans.catalog import queries  # noqa: E402
from dimloom.session import RUNTIME_CONF, ensure_checkpoint_dir  # noqa: E402


def main() -> None:
    sf, name = sys.argv[1], sys.argv[2]
    log_dir = tempfile.mkdtemp(prefix="dimloom-eventlog-", dir=os.environ.get("TMPDIR", "/tmp"))
    b = (SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_CPUS", "8"))
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
         .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false"))
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    q = queries()[name]
    q(spark, sf).write.format("noop").mode("overwrite").save()
    t0 = time.time() * 1000
    q(spark, sf).write.format("noop").mode("overwrite").save()
    t1 = time.time() * 1000
    spark.stop()

    events = [json.loads(line) for f in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(f)
              for line in open(f)]
    starts = {e["Job ID"]: e["Submission Time"] for e in events
              if e["Event"] == "SparkListenerJobStart" and e["Submission Time"] >= t0}
    ends = {e["Job ID"]: e["Completion Time"] for e in events if e["Event"] == "SparkListenerJobEnd"}
    stages = [e["Stage Info"] for e in events if e["Event"] == "SparkListenerStageCompleted"
              and e["Stage Info"].get("Submission Time", 0) >= t0]
    busy, cur = 0, None
    for s, e in sorted((starts[j], ends[j]) for j in starts):
        if cur is None or s > cur[1]:
            busy += (cur[1] - cur[0]) if cur else 0
            cur = [s, e]
        else:
            cur[1] = max(cur[1], e)
    busy += (cur[1] - cur[0]) if cur else 0
    print(f"{name}: wall {t1 - t0:.0f} ms, {len(starts)} jobs, {len(stages)} stages, jobs running {busy} ms")
    stages.sort(key=lambda s: s["Completion Time"] - s["Submission Time"], reverse=True)
    for s in stages[:10]:
        ops = sorted({json.loads(r["Scope"])["name"] for r in s.get("RDD Info", []) if r.get("Scope")})
        print(f"  {s['Completion Time'] - s['Submission Time']:6d} ms  tasks={s['Number of Tasks']:4d}  {', '.join(ops)[:110]}")


if __name__ == "__main__":
    main()
