import os
import subprocess
import sys


def test_dense_key_survives_task_retries():
    here = os.path.dirname(os.path.abspath(__file__))
    out = subprocess.run([sys.executable, os.path.join(here, "retry_job.py")], capture_output=True,
                         text=True, timeout=600)
    lines = [line for line in out.stdout.splitlines() if line.startswith("RESULT")]
    assert lines == ["RESULT rows=20000 diff=0"], out.stdout[-2000:] + out.stderr[-2000:]
