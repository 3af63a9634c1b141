"""The command line, in-process on the test session."""

import json

from parcelwise.__main__ import main
from parcelwise.plans import registry as Rg
from parcelwise.session import shared_path
from parcelwise.sinks import writers as W
from parcelwise.sources import readers as SR


def test_cli_jobs(spark, sf_small, capsys):
    base = shared_path(spark, "t_cli")
    source = f"{base}/source"
    W.write_csv(Rg.source_text(spark, sf_small), source)

    assert main(["ingest", "--source", source, "--landed", f"{base}/landed", "--run-ts", "2024-01-01 06:00:00"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"landed_rows": 5902}

    assert main(["transform", "--landed", f"{base}/landed", "--out", f"{base}/kpis"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["warehouse_kpis"] == 5 and out["clean"] == 5835

    assert main(["report", "rolling_delay", "--landed", f"{base}/landed", "--out", f"{base}/r5"]) == 0
    assert spark.read.parquet(f"{base}/r5").count() == 2279

    assert main(["report", "all", "--landed", f"{base}/landed", "--out", f"{base}/reports"]) == 0
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counts == {"on_time_by_warehouse": 6, "high_risk_routes": 15, "rating_distribution": 42,
                      "monthly_volume": 252, "rolling_delay": 2279}

    assert main(["run", "--source", source, "--base", f"{base}/run", "--date", "2024-01-01"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["status"] == "SUCCESS"

    assert main(["publish", "--landed", f"{base}/landed", "--topic", f"{base}/topic"]) == 0
    assert main(["stream", "--topic", f"{base}/topic", "--sink", f"{base}/events", "--checkpoint", f"{base}/ckpt"]) == 0
    assert SR.read_landed(spark, f"{base}/events").count() == 5902
