"""How many rows of a table the jobs of a block read, from the event log."""

import glob
import json
from contextlib import contextmanager
from urllib.parse import urlparse


def _nodes(plan):
    yield plan
    for child in plan.get("children", []):
        yield from _nodes(child)


@contextmanager
def rows_read(spark, table):
    """Yields a list that holds, after the block, the rows that all executed
    scans of ``table`` gave out together."""
    sc = spark.sparkContext
    where = urlparse(sc.getConf().get("spark.eventLog.dir")).path
    path, = glob.glob(f"{where}/{sc.applicationId}*")
    wait = lambda: sc._jsc.sc().listenerBus().waitUntilEmpty()
    wait()
    with open(path) as log:
        log.seek(0, 2)
        out = []
        yield out
        spark.range(1).collect()  # the end of its job flushes the log
        wait()
        ids, values = set(), {}
        for line in log:
            event = json.loads(line)
            for node in _nodes(event.get("sparkPlanInfo", {})):
                if f"/{table}.parquet" in node.get("metadata", {}).get("Location", ""):
                    ids |= {m["accumulatorId"] for m in node["metrics"] if m["name"] == "number of output rows"}
            if event["Event"] == "SparkListenerStageCompleted":
                for a in event["Stage Info"]["Accumulables"]:
                    values[a["ID"]] = a["Value"]
        out.append(sum(int(values.get(i, 0)) for i in ids))
