"""Command line: validate, seed, run, push, stats, catalog and audit."""

from __future__ import annotations

import argparse
import json
import os
from pathlib import Path

from loomfold.operators import audit, report
from loomfold.operators.normalize import to_rows
from loomfold.plans import pipeline
from loomfold.session import local_session
from loomfold.sources import readers, sinks
from loomfold.sources.registry import load_registry


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="loomfold", description="Curate agent training data with Spark.")
    top.add_argument("--registry", default="registry.yaml")
    top.add_argument("--root", default="raw", help="folder of the raw sources")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, *options: tuple) -> None:
        own = commands.add_parser(name)
        for names, settings in options:
            own.add_argument(*names, **settings)

    choice = [(("--tier",), {"nargs": "*"}), (("--key",), {"nargs": "*"})]
    out = (("--out",), {"default": "data/expansion"})
    command("validate", *choice, (("-n", "--n-rows"), {"type": int, "default": 5}), (("--show",), {"type": int, "default": 3}), (("--dump",), {"action": "store_true"}))
    command("seed", (("--path",), {"required": True}), (("--cache",), {"default": "data/hashes"}), (("--limit",), {"type": int}))
    command(
        "run", *choice, out, (("--limit",), {"type": int}), (("--seed-limit",), {"type": int}), (("--dedup-against",), {}),
        (("--no-seed-dedup",), {"action": "store_true"}), (("--no-near",), {"action": "store_true"}), (("--cache",), {"default": "data/hashes"}), (("--skip-corrupt",), {"action": "store_true"}),
    )
    command("push", out, (("--repo",), {"required": True}), (("--public",), {"action": "store_true"}), (("--dry-run",), {"action": "store_true"}), (("--min-rows",), {"type": int, "default": 0}), (("--wait-pid",), {"type": int}))
    command("stats", out)
    command("catalog", (("--outfile",), {"default": "CATALOG.md"}))
    command("audit", out)
    return top


def _selected(registry, args):
    return registry.by_key(args.key) if args.key else registry.by_tier(args.tier)


def _alive(pid: int) -> bool:
    try:
        os.kill(pid, 0)
    except ProcessLookupError:
        return False
    except PermissionError:
        return True
    return True


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "catalog":
        registry = load_registry(args.registry)
        Path(args.outfile).write_text(report.catalog_markdown(registry), encoding="utf-8")
        print(f"wrote {args.outfile} ({len(registry.sources)} datasets, {sum(s.wired for s in registry.sources)} wired)")
        return 0
    spark = local_session()
    if args.command == "stats":
        print(json.dumps(sinks.read_report(spark, f"{args.out}/_report.json"), indent=2, ensure_ascii=False))
        return 0
    if args.command == "push":
        if args.wait_pid:
            done = sinks.publish_when_done(spark, lambda: _alive(args.wait_pid), args.out, args.repo, lambda told: report.card_markdown(args.repo, told), args.min_rows or sinks.LEAST_ROWS, private=not args.public)
            print(done or "nothing to publish")
            return 0 if done else 1
        told = sinks.read_report(spark, f"{args.out}/_report.json")
        if not sinks.may_publish(told, args.min_rows):
            print(f"too few rows to publish: {(told or {}).get('total_written', 0)}")
            return 1
        print(sinks.publish(spark, args.out, args.repo, report.card_markdown(args.repo, told), not args.public, args.dry_run))
        return 0
    if args.command == "audit":
        rows = readers.read_shards(spark, f"{args.out}/data")
        audit.totals(rows).orderBy("defect").show(50, False)
        audit.worst_sources(rows).orderBy("source", "place").show(50, False)
        return 0
    if args.command == "seed":
        hashes = readers.reference_hashes(spark, readers.read_shards(spark, args.path), args.cache, args.path, args.limit)
        print(f"{hashes.count()} hashes")
        return 0
    registry = load_registry(args.registry)
    if args.command == "validate":
        for source in _selected(registry, args):
            try:
                rows = pipeline.check_source(spark, source, args.root, args.n_rows).select("reason", "messages_json", "id").collect()
            except ValueError as e:
                print(e)
                continue
            good = [r for r in rows if r.reason is None]
            print(f"{source.key} -> ok={len(good)} bad={len(rows) - len(good)}")
            for r in rows[: args.show]:
                print("  ", r.reason or "ok", r.messages_json if args.dump else (r.messages_json or "")[:200])
        return 0
    against = None
    if args.dedup_against and not args.no_seed_dedup:
        against = readers.reference_hashes(spark, readers.read_shards(spark, args.dedup_against), args.cache, args.dedup_against, args.seed_limit)
    told = pipeline.run(spark, registry, args.root, args.out, args.tier, args.key, against, False if args.no_near else None, args.limit, skip_corrupt=args.skip_corrupt)
    print(json.dumps({k: told[k] for k in ("total_written", "dedup", "errors")}, ensure_ascii=False))
    return 0


__all__ = ["main", "parser", "to_rows"]

if __name__ == "__main__":
    raise SystemExit(main())
