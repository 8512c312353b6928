"""What the spark-submit entry points share: a session, the control tables of a
catalog, one action, and the session's end."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from strata.plans.control import CATALOG_DEFAULT, ControlPlane
from strata.session import build_session, warehouse_root
from strata.sources.tables import TableStore

Flags = dict[str, dict]


def run_job(app: str, about: str, flags: Flags, action: Callable, argv=None) -> None:
    """Parse ``flags`` (name -> argparse settings) and call
    ``action(spark, control, options)``."""
    shared: Flags = {"--catalog": {"default": CATALOG_DEFAULT}, "--warehouse": {"help": "table root (default: the session's)"}}
    parser = argparse.ArgumentParser(description=about)
    for name, settings in {**shared, **flags}.items():
        parser.add_argument(name, **settings)
    options = parser.parse_args(argv)
    spark = build_session(app)
    try:
        control = ControlPlane(TableStore(spark, options.warehouse or warehouse_root(spark)), options.catalog)
        control.bootstrap()
        action(spark, control, options)
    finally:
        spark.stop()
