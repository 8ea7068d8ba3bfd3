import json

from tideline import cli
from tideline.operators.meters import report_from_meters
from tideline.plans.ingest import events_spec
from tideline.session import scratch_path
from tideline.sources import fixtures as fx
from tideline.streaming.ingest import read_meters

SPEC = {
    "dataSchema": {
        "dataSource": "events",
        "fields": [
            {"name": "event_type"},
            {"name": "origin"},
            {"name": "value", "type": "double", "role": "metric"},
        ],
    },
    "ioConfig": {
        "topic": "events",
        "minimumMessageTime": "2024-01-05T00:00:00Z",
        "maximumMessageTime": "2024-01-25T00:00:00Z",
    },
}


def test_cli_batch_and_stream(spark, tmp_path, capsys):
    from datetime import datetime

    spec_file = tmp_path / "spec.json"
    spec_file.write_text(json.dumps(SPEC))
    landing = scratch_path(spark, "cli-landing")
    fx.envelopes(spark, "/root/testdata/sf0.001").repartition(3).write.parquet(landing)
    root = scratch_path(spark, "cli-batch")
    cli.main([str(spec_file), "--landing", landing, "--root", root, "--mode", "batch"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["processed"] + out["unparseable"] + out["thrown_away"] == 1000
    root2 = scratch_path(spark, "cli-stream")
    cli.main([str(spec_file), "--landing", landing, "--root", root2, "--mode", "stream"])
    meters = read_meters(spark, f"{root2}/meters")
    rep = report_from_meters(meters, events_spec(), datetime(2024, 2, 1)).first()
    assert (rep["processed"], rep["unparseable"], rep["thrown_away"]) == (
        out["processed"],
        out["unparseable"],
        out["thrown_away"],
    )
