"""Run one replay request, or every requested one."""

from strata.jobs.runner import run_job
from strata.plans.replay import run_requested_replays

FLAGS = {"--replay-request-id": {"type": int}}


def main(argv=None) -> None:
    run_job("strata-replay", __doc__, FLAGS, lambda spark, control, o: run_requested_replays(spark, control, o.replay_request_id), argv)


if __name__ == "__main__":
    main()
