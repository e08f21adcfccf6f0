import json
import uuid

from pyspark.sql import functions as F

from strata.__main__ import main
from strata.session import fresh_dir
from strata.sources import landing
from tests.conftest import SF_SMALL


def test_cli_declare_run_load_report(spark, capsys):
    root = fresh_dir(spark, "cli")
    u = uuid.uuid4().hex[:6]
    common = ["--root", root, "--registry", "strata.workloads:event_entities",
              "--bronze-db", f"b_{u}", "--silver-db", f"s_{u}", "--gold-db", f"g_{u}"]
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("event_date", F.to_date("ts"))
    landing.write_landing(ev.where(F.col("event_date") <= F.lit("2024-01-10").cast("date")),
                          f"{root}/landing/events", "event_date")
    assert main(["declare", *common]) == 0
    assert main(["run", *common, "--load-ts", "2024-01-11 00:00:00"]) == 0
    landing.write_landing(ev.where(F.col("event_date") > F.lit("2024-01-10").cast("date")),
                          f"{root}/landing/events", "event_date")
    capsys.readouterr()
    for layer in ("bronze", "silver", "gold"):
        assert main(["load", layer, *common, "--entity", "user", "--load-ts", "2024-02-01 00:00:00"]) == 0
    out = [json.loads(l) for l in capsys.readouterr().out.splitlines() if l.startswith("{")]
    assert [o["layer"] for o in out] == ["bronze", "silver", "gold"]
    assert out[0]["rows"] == ev.where(F.col("event_date") > F.lit("2024-01-10").cast("date")).count()
    assert main(["report", *common]) == 0
    rep = {o["entity"]: o for o in map(json.loads, (l for l in capsys.readouterr().out.splitlines()
                                                     if l.startswith("{")))}
    assert rep["user"]["ok"] and rep["user"]["active_rows"] == ev.select("user_id").distinct().count()
    assert rep["event"]["ok"]
