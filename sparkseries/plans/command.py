"""Run declared ingests: python -m sparkseries.plans.command DETAILS.py ... [key=value ...] [--dry-run]

A declaration file defines `get_ingests(**config)`, which gives a list, or `get_ingest(**config)`, which gives one.
"""

from __future__ import annotations

import argparse
import datetime as dt
import importlib.util
from collections.abc import Callable
from pathlib import Path

from ..session import build_session
from . import runner


def declaration(path: str) -> Callable[..., list[runner.Ingest]]:
    """The function of a declaration file that makes its ingests."""
    spec = importlib.util.spec_from_file_location(Path(path).stem, path)
    if spec is None or spec.loader is None:
        raise ValueError(f"{path} is not a Python file")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    if hasattr(module, "get_ingests"):
        return lambda **config: list(module.get_ingests(**config))
    if hasattr(module, "get_ingest"):
        return lambda **config: [module.get_ingest(**config)]
    raise ValueError(f"{path} defines neither get_ingests nor get_ingest")


def run_files(spark, items: list[str], as_of, dry_run: bool = False, on_error: str = "raise") -> list[runner.Run]:
    config = runner.config_of(items)
    results = []
    for path in (item for item in items if "=" not in item):
        results += runner.run_all(spark, declaration(path), as_of, config, dry_run=dry_run, on_error=on_error)
    return results


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("items", nargs="+", help="declaration files and key=value settings")
    parser.add_argument("--dry-run", action="store_true")
    parser.add_argument("--continue-on-error", action="store_true")
    parser.add_argument("--as-of", default=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" "))
    chosen = parser.parse_args(arguments)
    spark = build_session("ingest")
    on_error = "continue" if chosen.continue_on_error else "raise"
    for result in run_files(spark, chosen.items, chosen.as_of, chosen.dry_run, on_error):
        for _ingest, target, status, rows, seconds, error in result.entries:
            print(f"{result.name}: {target} {status}, {rows} rows, {seconds:.1f} s{', ' + error if error else ''}")


if __name__ == "__main__":
    main()
