"""``spark-submit ledgerloom/cli.py --source DIR --published-dir DIR``: a full rebuild, promoted if nothing stands against it."""

from __future__ import annotations

import argparse
import datetime
import sys

from ledgerloom.operators import publish, quality
from ledgerloom.plans import rebuild
from ledgerloom.session import build_session, release, ship

REQUIRED = ["by-session", "by-ministry", "by-member", "members", "ministries", "constituencies", "sessions", "resolution-records", "coverage"]
QUESTIONS = ("by-session/ndjson", "by-ministry/ndjson", "by-member/ndjson")


def main(argv: list[str] | None = None) -> int:
    """0 if the new snapshot took the old one's place, else 1; then the previous one stays, stamped with the reason.

    A build left complete by an earlier run is used again only with ``--resume``, and the manifest says so; without, it is
    built anew, so that old data never passes for fresh.
    """
    parser = argparse.ArgumentParser(prog="ledgerloom")
    parser.add_argument("--source", required=True, help="folder of the landed tables")
    parser.add_argument("--published-dir", required=True, help="folder of the current snapshot")
    parser.add_argument("--previous", help="snapshot to keep if this build fails (the current one)")
    parser.add_argument("--resume", action="store_true", help="use the complete build an earlier run left")
    parser.add_argument("--full-pool", action="store_true", help="resolve against the members of all terms, not each question's own")
    parser.add_argument("--no-approximate", action="store_true", help="leave the approximate tier out")
    parser.add_argument("--accept-differing", action="store_true", help="publish the first of copies that differ, and say how many in the manifest")
    args = parser.parse_args(argv)
    spark = build_session()
    ship(spark)
    stamp = datetime.datetime.now(datetime.UTC).replace(microsecond=0).isoformat()
    building = f"{args.published_dir}.building"
    try:
        if args.resume and not publish.inspect_previous(spark, building, REQUIRED, QUESTIONS):
            content = publish.read_manifest(spark, building)
            publish.write_manifest(spark, content | {"provenance": {"mode": "resumed", "written_at": content["last_refreshed"]}}, building)
        else:
            publish.remove(spark, building)
            made = rebuild.build(spark, args.source, approximate=not args.no_approximate, full_pool=args.full_pool)
            accepted = made.checks.where("stage <> 'deduplication'") if args.accept_differing else made.checks
            failed = quality.ingestion_failures(accepted)
            if not quality.should_publish(failed):
                raise publish.PublishError("; ".join(r.detail for r in failed.collect()))  # one row a check
            told = {r.reason: r.records for r in made.checks.collect()}
            rebuild.write(spark, made, building, stamp, provenance={"mode": "built", "written_at": stamp}, checks=told)
        if not publish.promote(spark, building, args.published_dir, REQUIRED, QUESTIONS):
            raise publish.PublishError("the new snapshot is not whole or could not take its place")
    except Exception as error:  # noqa: BLE001 - whatever failed, the previous snapshot is kept and says why
        reason = f"{type(error).__name__}: {str(error).splitlines()[0][:200] if str(error) else ''}"
        lacks = publish.retain(spark, args.previous or args.published_dir, args.published_dir, REQUIRED, reason, stamp[:10], QUESTIONS)
        print(f"not published ({reason}); " + (f"no previous snapshot to keep, it lacks {', '.join(lacks)}" if lacks else "the previous one stays"), file=sys.stderr)
        return 1
    finally:
        release(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
