"""The spark-submit entry points run as their own processes."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(module, *args):
    scratch = tempfile.mkdtemp(prefix="strata-job-")
    env = {**os.environ, "PYTHONPATH": ROOT}
    return subprocess.run(
        [sys.executable, "-m", module, "--warehouse", os.path.join(scratch, "wh"), *args],
        capture_output=True, text=True, timeout=300, env=env, cwd=scratch,
    )


def test_pipeline_job_without_sources_fails_clearly():
    done = _run("strata.jobs.run_pipeline", "--parallelism", "2")
    assert done.returncode != 0
    assert "No active sources were found" in done.stderr


def test_replay_job_without_requests_fails_clearly():
    done = _run("strata.jobs.replay_runner")
    assert done.returncode != 0
    assert "No replay request is waiting" in done.stderr
