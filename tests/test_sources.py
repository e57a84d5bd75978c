"""Tables, incremental runs, paged sources, the model's folders, logs and the command line."""

from __future__ import annotations

import json
import logging
import random
import statistics
import threading
import urllib.parse
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from brickwork import cli, logs
from brickwork.config import EngineConfig, ModelConfig
from brickwork.operators import aggregates, audit, model, silver
from brickwork.plans import pipeline
from brickwork.schemas import TRAINING
from brickwork.sources import paged, tables
from tests.test_engine import HIT


def _hits(folder, name, numbers, **more):
    rows = [HIT | {"externalID": f"e{i}", "area": 100.0 + i, "price": 1e6 + i} | more for i in numbers]
    (folder / name).write_text("\n".join(json.dumps(h, ensure_ascii=False) for h in rows))


def test_store_appends_parts(spark, tmp_path, monkeypatch):
    store = tables.Store(spark, f"file://{tmp_path}")
    rows = lambda *ids: spark.createDataFrame([(i, "c", "n", "p") for i in ids], "id bigint, city string, neighbourhood string, province string")
    assert store.read("locations").count() == 0 and not store.exists("locations")
    store.append("locations", rows(1, 2))
    first = store.parts("locations")
    store.append("locations", rows(3))
    assert store.parts("locations")[:1] == first and len(store.parts("locations")) == 2
    old = store.read("locations")
    store.write("locations", rows(9))
    assert [r["id"] for r in store.read("locations").collect()] == [9] and old.count() == 3  # readers of a kept manifest go on
    for i in range(4):
        store.write("locations", rows(i))
    assert len(list((tmp_path / "locations").glob("part-*"))) == len(list((tmp_path / "locations").glob("manifest-*"))) == tables.KEPT
    with pytest.raises(RuntimeError, match="another writer"):
        store._commit("locations", store._manifests("locations")[-1] - 1, [])
    monkeypatch.setattr(tables, "MOST_PARTS", 2)
    for i in range(5, 8):
        store.append("locations", rows(i))
    assert len(store.parts("locations")) <= 2 and store.read("locations").count() == 4
    assert store.check()["locations"] == "ok" and store.check()["listings"] == "missing"
    rows(1).drop("city").write.parquet(f"{tmp_path}/buildings/part-x")
    store._commit("buildings", 0, ["part-x"])
    assert store.check()["buildings"].startswith("differs in ['location_id', 'name'")


def test_a_run_takes_new_files_only(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    cfg = EngineConfig(root=f"file://{tmp_path}/tables", vector_size=8, archive=f"file://{tmp_path}/taken")
    store = tables.Store(spark, cfg.root)
    with pytest.raises(FileNotFoundError):
        raw.joinpath("_x").write_text("")
        pipeline.run_pipeline(spark, cfg, f"file://{raw}")
    _hits(raw, "a.jsonl", range(6))
    pipeline.run_pipeline(spark, cfg, f"file://{raw}")
    first = store.parts("bronze_listings")
    _hits(raw, "b.jsonl", range(4, 9), _scraped_at="20240105T000000Z")
    pipeline.run_pipeline(spark, cfg, f"file://{raw}")
    parts = store.parts("bronze_listings")
    assert parts[:1] == first and len(parts) == 2
    assert spark.read.parquet(f"{cfg.root}/bronze_listings/{parts[1]}").count() == 5
    assert store.read("silver_listings").count() == store.read("listings").count() == 9
    assert sorted(x.name for x in (tmp_path / "taken").glob("*.jsonl")) == ["a.jsonl", "b.jsonl"] and not list(raw.glob("*.jsonl"))
    pipeline.run_pipeline(spark, cfg, f"file://{raw}")
    assert store.parts("bronze_listings") == parts and store.read("processed_files").count() == 2


def test_rows_without_a_stamp_keep_the_files_time(spark, tmp_path):
    _hits(tmp_path, "a.jsonl", range(2), _scraped_at=None)
    read = lambda: sorted(silver.flatten(tables.read_hits(spark, str(tmp_path))).select("external_id", "scraped_at").collect())
    once = read()
    assert once == read() and all(r["scraped_at"] is not None for r in once)


@pytest.fixture
def server():
    """A search index of 7 pages and a table of 23 rows; the first answer of each kind fails."""
    failed, asked = set(), []

    class Handler(BaseHTTPRequestHandler):
        def _answer(self, body, headers=()):
            kind = self.command
            if kind not in failed:
                failed.add(kind)
                self.send_error(503)
                return
            self.send_response(200)
            for k, v in headers:
                self.send_header(k, v)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def do_POST(self):
            ask = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append(ask)
            hits = [{"id": ask["page"] * 10 + i, "purpose": "for-sale", "category": [{"slug": "residential"}]} for i in range(3)]
            self._answer({"hits": hits if ask["page"] < 7 else [], "nbPages": 7})

        def do_GET(self):
            q = urllib.parse.parse_qs(urllib.parse.urlparse(self.path).query)
            at, n = int(q["offset"][0]), int(q["limit"][0])
            self._answer([{"a": i} for i in range(23)][at : at + n], [("Content-Range", f"{at}-{at + n}/23")] if "counted" in self.path else [])

        def log_message(self, *_):
            pass

    found = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=found.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{found.server_port}", asked
    found.shutdown()


def test_paged_sources(spark, server):
    url, asked = server
    paged.register(spark)
    search = spark.read.format("paged_search").option("url", url).option("pause", "0").option("spans", "3").load()
    ids = search.where("purpose = 'for-sale'").select(F.get_json_object("value", "$.id").cast("int").alias("id")).collect()
    assert sorted(r["id"] for r in ids) == [p * 10 + i for p in range(7) for i in range(3)]
    assert {a["filters"] for a in asked[1:]} == {'purpose:"for-sale"'}
    for path in ("counted", "plain"):
        rows = spark.read.format("paged_table").option("url", f"{url}/{path}").option("pause", "0").option("pageSize", "5").option("columns", "a").load()
        assert sorted(json.loads(r["value"])["a"] for r in rows.collect()) == list(range(23))
    with pytest.raises(Exception, match="missing columns"):
        spark.read.format("paged_table").option("url", url).option("pause", "0").option("columns", "a,b").load().collect()


def test_group_quantiles(spark):
    r = random.Random(1)
    rows = [(r.choice(["a", "b", None]), r.choice([None, 1.0, 2.5, r.random()])) for _ in range(400)] + [("one", 7.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {x["g"]: x["q"] for x in aggregates.group_quantiles(df, "g", "v", [0.005, 0.25, 0.5]).collect()}
    wanted = {x["g"]: x["q"] for x in df.where("v IS NOT NULL").groupBy("g").agg(F.percentile("v", F.array(F.lit(0.005), F.lit(0.25), F.lit(0.5))).alias("q")).collect()}
    assert got.keys() == wanted.keys() and all(got[k] == pytest.approx(wanted[k]) for k in got)
    assert got["one"] == [7.0] * 3 and aggregates.group_quantiles(df.limit(0), "g", "v", [0.5]).count() == 0


def test_describe_and_singletons(spark):
    values = [3.0, 1.0, 4.0, 1.5, 9.0]
    df = spark.createDataFrame([(v, "x" if v > 1 else "y") for v in values] + [(None, "z")], "v double, k string")
    row = audit.describe(df, ["v"]).first()
    assert (row["count"], row["min"], row["q2"], row["max"]) == (5, 1.0, 3.0, 9.0) and row["std"] == pytest.approx(statistics.stdev(values))
    assert tuple(audit.singleton_share(df, ["k"]).first()) == (3, 2, pytest.approx(2 / 3))


def test_retrain_and_command_line(spark, tmp_path, capsys):
    r = random.Random(3)
    rows = [(i, (a := r.uniform(60, 400)) * 9000, 9000.0, "", 1, r.choice(["Apartment", "Villa"]), r.choice("xy"), None, 2.0, 1.0, a, 3, 9000.0, False) for i in range(300)]
    df = spark.createDataFrame(rows, TRAINING)
    cfg = ModelConfig(min_rows=100)
    with pytest.raises(FileNotFoundError):
        model.current(spark, f"{tmp_path}/models")
    fitted, one = model.retrain(df, f"{tmp_path}/models", cfg, kind="ridge")
    assert fitted.kind == "ridge" and fitted.metrics["cv_r2"] == {} and fitted.metrics["holdout"]["r2"] > 0.5
    _, two = model.retrain(df, f"{tmp_path}/models", cfg, kind="dummy", holdout=False)
    (tmp_path / "models" / "99999999T").mkdir()  # not saved whole
    assert model.versions(spark, f"{tmp_path}/models") == [one, two] and model.current(spark, f"{tmp_path}/models").kind == "dummy"
    assert model.importances(model.current(spark, f"{tmp_path}/models")) == [] and model.importances(fitted, 2)[0][0] in [*model.NUMERIC, "te_city", "te_neighbourhood", "property_type=Villa", "property_type=Apartment"]
    (tmp_path / "ask.csv").write_text("property_type,city,neighbourhood,rooms,baths,area_m2\nVilla,x,,2,1,100\n")
    assert cli.main(["--log-style", "text", "predict", f"{tmp_path}/models", f"{tmp_path}/ask.csv", f"{tmp_path}/out"]) == 0
    assert spark.read.option("header", True).csv(f"{tmp_path}/out").first()["predicted_price_egp"] is not None
    raw = tmp_path / "raw"
    raw.mkdir()
    _hits(raw, "a.jsonl", [1, 1, 2], title="شقة B6")
    assert cli.main(["run", f"file://{tmp_path}/t", f"file://{raw}"]) == 0 and cli.main(["check", f"file://{tmp_path}/t"]) == 0
    assert cli.main(["audit", f"file://{tmp_path}/t", f"{tmp_path}/audit"]) == 0
    found = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert found["listings"] == "ok" and found["buildings"] == "missing"
    assert spark.read.option("header", True).csv(f"{tmp_path}/audit").columns[:1] == ["property_id"]


def test_json_logs():
    record = logging.makeLogRecord({"name": "n", "levelname": "INFO", "msg": "done %s", "args": ("x",), "run_id": "r1", "odd": {1}})
    line = json.loads(logs.JsonFormatter().format(record))
    assert (line["message"], line["run_id"], line["logger"], line["odd"]) == ("done x", "r1", "n", "{1}")
