"""Run one source, or every active source."""

from strata.jobs.runner import run_job
from strata.plans.runs import run_all_sources

FLAGS = {
    "--source": {"help": "one source; default: all active ones"},
    "--requested-by": {"default": "runtime"},
    "--forced-batch-id": {"type": int},
    "--parallelism": {"type": int, "default": 1, "help": "sources at a time (1: stop at the first failure)"},
}


def main(argv=None) -> None:
    run_job("strata-pipeline", __doc__, FLAGS, lambda spark, control, o: run_all_sources(
        spark, control, o.source, o.forced_batch_id, o.requested_by, parallelism=o.parallelism), argv)


if __name__ == "__main__":
    main()
