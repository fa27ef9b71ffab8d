"""Command line: ``python -m siftlane.cli merge|validate|version``."""

from __future__ import annotations

import argparse
import json
import sys

from . import __version__
from .config import ConfigError, load_config


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="siftlane")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("merge")
    run.add_argument("--config", required=True)
    run.add_argument("--output-dir", default="output")
    run.add_argument("--cache-dir")
    run.add_argument("--previous", help="an earlier block list to compare with")
    run.add_argument("--no-cache", action="store_true", help="fetch and parse everything anew")
    run.add_argument("--verbose", action="store_true")
    run.add_argument("--quiet", action="store_true")
    wipe = commands.add_parser("clear-cache")
    wipe.add_argument("--cache-dir", required=True)
    commands.add_parser("validate").add_argument("--config", required=True)
    commands.add_parser("version")
    args = parser.parse_args(argv)
    if args.command == "version":
        print(__version__)
        return 0
    if args.command == "clear-cache":
        from .runtime import session
        from .sources import landing
        from .sources.store import Store

        print(landing.clear(args.cache_dir, Store(session("siftlane clear-cache"))))
        return 0
    try:
        config = load_config(args.config, not getattr(args, "no_cache", False))
    except ConfigError as e:
        print(e, file=sys.stderr)
        return 1
    if args.command == "validate":
        print(f"{len(config.enabled)} sources are enabled")
        return 0
    from .pipeline import merge
    from .runtime import session

    metrics = merge(session("siftlane merge"), config, args.output_dir, args.cache_dir, args.previous)
    if not args.quiet:
        long = () if args.verbose else ("contributions", "overlap", "suffixes")
        print(json.dumps({k: v for k, v in metrics.items() if k not in long}, indent=2, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
