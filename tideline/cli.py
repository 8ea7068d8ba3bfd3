"""Run an ingest spec: ``python -m tideline.cli spec.json --root <shared folder>``.

The spec is the JSON a user submits.  ``--mode batch`` ingests what is new in the
landing folder since the last run, in commits under the next batch numbers;
``--mode stream`` starts query 1 with
``availableNow`` (drain and stop) or, with ``--continuous``, a processing-time
trigger of ``intermediateHandoffPeriod``.  Output folders live under
``--root``: ``rows``, ``ledger``, ``meters``, ``checkpoint``.  ``--subscription
label=folder`` (several times) feeds the table from several landing folders.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tideline.session import ensure_utc
from tideline.sources.manifest import Landing
from tideline.spec import IngestSpec
from tideline.streaming.ingest import StreamPaths, ingest_landing, start_ingest


def paths_for(root: str, landing: str) -> StreamPaths:
    root = root.rstrip("/")
    return StreamPaths(landing, f"{root}/rows", f"{root}/ledger", f"{root}/meters", f"{root}/checkpoint")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("spec")
    ap.add_argument("--landing", help="landing folder (default: <root>/landing/<projectId>/<subscriptionId>)")
    ap.add_argument("--root", required=True)
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--mode", choices=["batch", "stream"], default="stream")
    ap.add_argument("--source", choices=["envelopes", "pulls"], default="envelopes")
    ap.add_argument("--multi-line", action="store_true", help="pull responses that span lines")
    ap.add_argument("--subscription", action="append", default=[], metavar="LABEL=FOLDER")
    ap.add_argument("--continuous", action="store_true")
    a = ap.parse_args(argv)
    with open(a.spec) as fh:
        spec = IngestSpec.from_json(fh.read())
    spark = SparkSession.builder.appName(f"tideline-{spec.data_source}").getOrCreate()
    ensure_utc(spark)
    landing = a.landing or spec.landing_path(f"{a.root.rstrip('/')}/landing")
    paths = paths_for(a.root, landing)
    folders = dict(x.split("=", 1) for x in a.subscription)
    if a.mode == "batch":
        where = Landing(folders or {None: landing}, a.format, a.source, a.multi_line)
        done = ingest_landing(spark, spec, paths, where)
        total = {k: sum(m[k] for m in done.values()) for k in ("processed", "unparseable", "thrown_away")}
        print(json.dumps({"data_source": spec.data_source, "batches": list(done), **total}))
        return
    q = start_ingest(spark, spec, paths, a.format, available_now=not a.continuous, source=a.source, multi_line=a.multi_line, subscriptions=folders)
    if q is None:
        print(json.dumps({"data_source": spec.data_source, "suspended": True}))
        return
    q.awaitTermination()


if __name__ == "__main__":
    main()
