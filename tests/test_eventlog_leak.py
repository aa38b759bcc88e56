"""No key bytes in Spark's event log (a separate JVM: event logging is set at start)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r'''
import glob, io, sys
sys.path.insert(0, {repo!r})
import zstandard
from laketide.session import build_session
from laketide.plans import catalog as C
from laketide.plans.oracle import MAIN_PADS, WORKSPACE_PADS
spark = build_session("local[2]", shuffle_partitions=2,
                      extra={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": {log!r}}})
for q in ("p1_pseudonymise", "a4_cross_org_link", "w1_workspace_extract"):
    getattr(C, q)(spark, "/root/testdata/sf0.001").collect()
spark.stop()
text = ""
for f in glob.glob({log!r} + "/*/*"):
    with open(f, "rb") as raw:
        if f.endswith(".zstd"):
            text += io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8").read()
        else:
            text += raw.read().decode()
low = text.lower()
assert len(low) > 10000
for needle in (C.TEST_KEY.hex(), *MAIN_PADS, *WORKSPACE_PADS):
    assert needle[:16] not in low
print("CLEAN")
'''


def test_no_key_bytes_in_event_log():
    log = tempfile.mkdtemp(prefix="laketide-eventlog-")
    code = SCRIPT.format(repo=REPO, log=log)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600)
    assert "CLEAN" in out.stdout, out.stderr[-2000:]
