"""Streams give what batches give; jobs write tables that read back."""

import json
import time

import pytest
from pyspark.sql import functions as F

from roadpulse.functions import geometry as geo
from roadpulse.model import ROAD_EDGES, TRAFFIC_EVENTS, conform
from roadpulse.operators import clean, gold, matching, roads, serving
from roadpulse.plans import fixtures as fx
from roadpulse.plans import jobs
from roadpulse.sources import deliveries, snapshots, tables
from roadpulse.streaming import flow as stream


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def landed(spark, sf, tmp_path_factory):
    """The snapshots as JSON files, some hours delivered twice."""
    path = str(tmp_path_factory.mktemp("raw"))
    snaps = fx.snapshots(spark, sf).cache()
    snaps.repartition(3).write.mode("append").json(path)
    snaps.filter(F.hour("sourceUpdated") == 5).coalesce(1).write.mode("append").json(path)
    return path


@pytest.fixture(scope="module")
def event_files(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events"))
    fx.traffic_events(spark, sf).repartitionByRange(4, "timestamp").write.mode("overwrite").parquet(path)
    return path


def test_clean_stream_equals_batch(spark, landed, sf, tmp_path):
    source = stream.unrepeated(stream.snapshot_stream(spark, landed), "60 days")
    stream.to_parquet(stream.clean_stream(source), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    wanted = clean.clean_flow(fx.snapshots(spark, sf))
    assert rows(got.select(wanted.columns)) == rows(wanted)


def test_window_stream_equals_batch_on_closed_windows(spark, event_files, sf, tmp_path):
    events = spark.readStream.schema(spark.read.parquet(event_files).schema).parquet(event_files)
    out = stream.windowed_stream(events, "1 hour", "30 minutes", "31 days", keys=("congestion_level",))
    q = out.writeStream.format("memory").queryName("windows").outputMode("complete").option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start()
    q.awaitTermination()
    wanted = gold.windowed_congestion(fx.traffic_events(spark, sf), "1 hour", "30 minutes", ("congestion_level",))
    rounded = lambda df: df.withColumns({c: F.round(c, 9) for c in ("avg_speed", "avg_jam")})
    assert rows(rounded(spark.table("windows"))) == rows(rounded(wanted))


def test_episode_stream_equals_batch_where_closed(spark, event_files, sf, tmp_path):
    events = spark.readStream.schema(spark.read.parquet(event_files).schema).parquet(event_files)
    out = stream.episode_stream(events, "6 hours", delay="1 day")
    q = out.writeStream.format("memory").queryName("episodes").outputMode("append").option("checkpointLocation", str(tmp_path)).trigger(availableNow=True).start()
    q.awaitTermination()
    wanted, got = set(rows(gold.jam_episodes(fx.traffic_events(spark, sf), "6 hours"))), set(rows(spark.table("episodes")))
    newest = fx.traffic_events(spark, sf).agg(F.max("timestamp")).first()[0]
    closed = gold.jam_episodes(fx.traffic_events(spark, sf), "6 hours").filter(F.col("episode_end") <= F.lit(newest) - F.expr("interval 1 day"))
    assert got <= wanted and set(rows(closed)) <= got


def test_latest_stream_equals_batch(spark, event_files, sf, tmp_path):
    schema = spark.read.parquet(event_files).schema
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(event_files)
    path = str(tmp_path / "latest")
    stream.keep_latest(events, path, str(tmp_path / "cp")).awaitTermination()
    wanted = rows(serving.latest_per_street(fx.traffic_events(spark, sf)))
    assert rows(stream.read_latest(spark, path).select(fx.traffic_events(spark, sf).columns)) == wanted
    # A batch that is replayed replaces itself.
    stream.latest_writer(path)(spark.read.parquet(event_files).limit(10), 0)
    stream.latest_writer(path)(spark.read.parquet(event_files), 0)
    assert rows(stream.read_latest(spark, path).select(fx.traffic_events(spark, sf).columns)) == wanted
    # A query with a new checkpoint counts batches from 0 and leaves the old ones.
    before = spark.read.parquet(path).select("run").distinct().count()
    stream.keep_latest(events, path, str(tmp_path / "cp2")).awaitTermination()
    assert spark.read.parquet(path).select("run").distinct().count() == before + 1
    assert stream.compact_latest(spark, path) > 2
    assert spark.read.parquet(path).select("run", "batch_id").distinct().count() == 1
    assert rows(stream.read_latest(spark, path).select(fx.traffic_events(spark, sf).columns)) == wanted


def test_road_and_traffic_jobs(spark, landed, sf, tmp_path):
    edges_path, network, segments = (str(tmp_path / n) for n in ("edges", "network", "segments"))
    silver, events = str(tmp_path / "silver"), str(tmp_path / "gold")
    fx.road_edges(spark, sf).withColumn("geometry", geo.to_wkb("geometry")).write.parquet(edges_path)
    counts = jobs.process_roads(spark, edges_path, network, segments)
    wanted = roads.build_road_segments(fx.road_edges(spark, sf))
    stored = tables.load_segments(spark, segments)
    every = roads.build_road_segments(fx.road_edges(spark, sf), id_scope="edge").count()
    assert counts == {"road_network": spark.read.parquet(network).count(), "road_segments": wanted.count(),
                      "dropped_chunks": every - wanted.count(), "edges_without_line": 0}
    assert rows(stored.select(wanted.columns)) == rows(wanted)
    assert {"xmin", "ymin", "xmax", "ymax"} <= set(stored.columns)

    flow = jobs.clean_traffic(spark, landed, silver)
    summary = jobs.process_traffic(spark, silver, segments, events)
    found = matching.match_snapshots(flow, stored)
    assert rows(conform(spark.read.parquet(events).drop("day", "snapshot"), TRAFFIC_EVENTS)) == rows(found)
    assert summary["input_count"] == flow.count() and summary["final_count"] == found.count() > 0
    assert summary["match_rate"] == summary["final_count"] * 100 // summary["input_count"]

    # A repeated run of one snapshot replaces its events, and a refresh of the roads replaces them.
    key = spark.read.parquet(events).agg(F.min("snapshot")).first()[0]
    assert jobs.process_traffic(spark, silver, segments, events, snapshot=key)["final_count"] > 0
    assert spark.read.parquet(events).count() == found.count()
    assert jobs.process_roads(spark, edges_path, network, segments) == counts

    labels_path, labelled = str(tmp_path / "labels"), str(tmp_path / "labelled")
    fx.street_labels(spark, sf).write.parquet(labels_path)
    jobs.label_traffic(spark, silver, labels_path, labelled)
    stored_labels = spark.read.parquet(labels_path).collect()
    assert len(stored_labels) == 15 and len({r.street_id for r in stored_labels}) == 15
    assert spark.read.parquet(labelled).count() == flow.count()


def test_windows_read_few_segment_files(spark, sf, tmp_path):
    path = str(tmp_path / "segments")
    segments = roads.build_road_segments(fx.road_edges(spark, sf))
    tables.write_segments(segments, path)
    shown = serving.visible_segments(spark.read.parquet(path), (105.805, 21.002, 105.815, 21.01), 16)
    plan = shown._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "LessThanOrEqual(xmin" in plan
    assert rows(shown.select("segment_id")) == rows(serving.visible_segments(segments, (105.805, 21.002, 105.815, 21.01), 16).select("segment_id"))


def test_landing_is_repeatable(spark, tmp_path):
    docs = [json.dumps({"sourceUpdated": "2024-01-01 05:00:00", "results": []}), json.dumps({"results": []})]
    payloads = spark.createDataFrame([(d,) for d in docs], "value string")
    for _ in range(2):
        snapshots.land_payloads(payloads, str(tmp_path))
    back = spark.read.text(str(tmp_path))
    assert {(r.value, str(r.day)) for r in back.collect()} == {(docs[0], "2024-01-01"), (docs[1], "unknown_time")} and back.count() == 2


def area(name, time="2024-01-01 05:00:00", confidence=0.9, speed=5.0):
    flow = {"speed": speed, "speedUncapped": 5.0, "freeFlow": 9.0, "jamFactor": 1.0, "confidence": confidence, "traversability": "open"}
    links = [{"points": [{"lat": 21.0, "lng": 105.8}, {"lat": 21.1, "lng": 105.8}], "length": 5.0, "functionalClass": "3"}]
    location = {"description": name, "length": 5.0, "shape": {"links": links}}
    return json.dumps({**({"sourceUpdated": time} if time else {}), "results": [{"location": location, "currentFlow": flow}]})


@pytest.mark.parametrize("time", ["2024-01-01 05:00:00", None])
def test_areas_of_one_time_stay_beside_each_other(spark, tmp_path, time):
    raw, silver = str(tmp_path / "raw"), str(tmp_path / "silver")
    for run in (["east"], ["west", "west"], ["east", "west"]):
        docs = spark.createDataFrame([(area(n, time),) for n in run], "value string")
        docs.write.mode("overwrite").text(raw)
        jobs.clean_traffic(spark, raw, silver)
        snapshots.land_payloads(docs, str(tmp_path / "landed"))
    assert sorted(r.street_name for r in deliveries.read(spark, silver).collect()) == ["east", "west"]
    assert spark.read.text(str(tmp_path / "landed")).count() == 2


def test_a_run_without_rows_clears_its_partition(spark, tmp_path):
    raw, silver = str(tmp_path / "raw"), str(tmp_path / "silver")
    spark.createDataFrame([(area("east", confidence=0.75),), (area("west"),)], "value string").write.text(raw)
    assert jobs.clean_traffic(spark, raw, silver).count() == 2
    jobs.clean_traffic(spark, raw, silver, min_confidence=0.8)
    assert [r.street_name for r in deliveries.read(spark, silver).collect()] == ["west"]


def arrive(spark, raw, *docs):
    """Files that come one after the other; their times differ."""
    for doc in docs:
        spark.createDataFrame([(doc,)], "value string").coalesce(1).write.mode("append").text(raw)
        time.sleep(0.05)


RESTATED = [area("east"), area("west"), area("east", speed=7.0), area("west"), area("east", "2024-01-01 06:00:00")]


def speeds(df):
    return sorted((r.street_name, r.timestamp.hour, r.speed) for r in df.collect())


def test_restated_payload_counts_once(spark, tmp_path):
    """In one run and over several: areas apart, a correction wins, a repeat counts once, an older one does not come back."""
    wanted = [("east", 5, 7.0), ("east", 6, 5.0), ("west", 5, 5.0)]
    whole = str(tmp_path / "whole")
    arrive(spark, whole, *RESTATED)
    silver = str(tmp_path / "one")
    assert speeds(jobs.clean_traffic(spark, whole, silver)) == wanted
    assert speeds(jobs.clean_traffic(spark, whole, silver)) == wanted and speeds(deliveries.read(spark, silver)) == wanted
    step = str(tmp_path / "steps")
    for n, doc in enumerate(RESTATED):
        raw = str(tmp_path / f"raw{n}")
        arrive(spark, raw, doc)
        got = jobs.clean_traffic(spark, raw, step)
    assert speeds(got) == wanted
    # A place that is now under the bound goes, as its newest delivery has no row for it.
    arrive(spark, str(tmp_path / "low"), area("west", confidence=0.1))
    assert speeds(jobs.clean_traffic(spark, str(tmp_path / "low"), step)) == wanted[:2]


def test_files_grow_with_runs_and_compaction_merges_them(spark, tmp_path):
    raw, silver = str(tmp_path / "raw"), str(tmp_path / "silver")
    arrive(spark, raw, *[area(f"street {n}", f"2024-01-01 {n % 24:02d}:{n % 60:02d}:00") for n in range(8)])
    docs = [(area(f"road {n}", f"2024-01-02 {n % 24:02d}:{n % 60:02d}:00"),) for n in range(300)]
    spark.createDataFrame(docs, "value string").coalesce(2).write.mode("append").text(raw)
    assert jobs.clean_traffic(spark, raw, silver).count() == 308
    parquet = lambda: [p for p in (tmp_path / "silver" / "data").rglob("*.parquet")]
    assert len(parquet()) <= 10
    arrive(spark, str(tmp_path / "more"), area("street 1", "2024-01-01 01:01:00", speed=9.0))
    before = speeds(jobs.clean_traffic(spark, str(tmp_path / "more"), silver))
    assert len(before) == 308 and ("street 1", 1, 9.0) in before
    assert deliveries.compact(spark, silver) == 2 and speeds(deliveries.read(spark, silver)) == before
    assert deliveries.remove_unlisted(spark, silver) >= 2 and speeds(deliveries.read(spark, silver)) == before
    assert deliveries.compact(spark, silver) == 0


def test_a_run_that_breaks_off_is_not_seen(spark, tmp_path, monkeypatch):
    raw, silver = str(tmp_path / "raw"), str(tmp_path / "silver")
    arrive(spark, raw, area("east"))
    before = speeds(jobs.clean_traffic(spark, raw, silver))
    arrive(spark, str(tmp_path / "new"), area("east", speed=9.0))
    with monkeypatch.context() as broken:
        broken.setattr(deliveries, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            jobs.clean_traffic(spark, str(tmp_path / "new"), silver)
    assert speeds(deliveries.read(spark, silver)) == before
    version, runs = deliveries.manifest(spark, silver)
    with pytest.raises(RuntimeError):
        deliveries._commit(spark, silver, version, runs)


def test_stream_of_restated_payloads_equals_batch(spark, tmp_path):
    raw, silver = str(tmp_path / "raw"), str(tmp_path / "silver")
    for n in range(0, len(RESTATED), 2):
        arrive(spark, raw, *RESTATED[n:n + 2])
        found = stream.arriving_rows(stream.snapshot_stream(spark, raw, 1, arrival=True), "2 days")
        stream.keep_flow(found, silver, str(tmp_path / "cp")).awaitTermination()
    batch = jobs.clean_traffic(spark, raw, str(tmp_path / "batch"))
    got = deliveries.read(spark, silver)
    assert speeds(got) == speeds(batch) == [("east", 5, 7.0), ("east", 6, 5.0), ("west", 5, 5.0)]
    assert rows(got.select(batch.columns)) == rows(batch)


def test_snapshots_that_match_nothing_lose_their_events(spark, tmp_path):
    raw, silver, segments, events = (str(tmp_path / n) for n in ("raw", "silver", "segments", "events"))
    line = "array(named_struct('x', 105.8D, 'y', 21.0D), named_struct('x', 105.8D, 'y', 21.05D))"
    tables.write_segments(spark.sql(f"select 's' as segment_id, 0D as azimuth, {line} as geometry"), segments)
    arrive(spark, raw, area("east"), area("west", "2024-01-01 07:00:00"))
    jobs.clean_traffic(spark, raw, silver)
    assert jobs.process_traffic(spark, silver, segments, events)["final_count"] == 2
    away = "array(named_struct('x', 1D, 'y', 1D), named_struct('x', 1D, 'y', 2D))"
    tables.write_segments(spark.sql(f"select 's' as segment_id, 0D as azimuth, {away} as geometry"), segments)
    with pytest.warns(UserWarning):
        assert jobs.process_traffic(spark, silver, segments, events)["final_count"] == 0
    assert not [p for p in (tmp_path / "events").rglob("*.parquet")]


def test_known_lines_are_not_matched_again(spark, sf, tmp_path, monkeypatch):
    from roadpulse.plans import matches

    flow = clean.clean_flow(fx.flow_raw(spark, sf)).cache()
    segments = roads.build_road_segments(fx.road_edges(spark, sf)).cache()
    _, lines = matching.snapshot_lines(flow)
    lines = lines.cache()
    some, table = lines.filter("line_key < '8'"), str(tmp_path / "matches")
    sent, real = [], matching.match_metrics
    monkeypatch.setattr(matching, "match_metrics", lambda given, *a, **k: (sent.append(given.count()), real(given, *a, **k))[1])
    wanted = rows(real(lines, segments, "line_key"))
    assert 0 < some.count() < lines.count()
    assert rows(matches.stored_metrics(some, segments, table)) == rows(real(some, segments, "line_key"))
    assert rows(matches.stored_metrics(lines, segments, table).select("line_key", "segment_id", "angle_diff", "overlap_length")) == wanted
    assert rows(matches.stored_metrics(lines, segments, table)) == wanted
    assert sent == [some.count(), lines.count() - some.count()]
    # Other segments, or another setting, are another version.
    turned = segments.withColumn("azimuth", F.expr("pmod(azimuth + 180, 360)"))
    assert rows(matches.stored_metrics(lines, turned, table)) == rows(real(lines, turned, "line_key"))
    assert rows(matches.stored_metrics(lines, segments, table, 0.0003)) == rows(real(lines, segments, "line_key", 0.0003))
    assert sent[2:] == [lines.count(), lines.count()]
    # Pairs of a run that broke off before its lines were written do not count.
    version = f"{table}/version={matches.segments_version(segments, matching.BUFFER_DEGREES, 'intersects')}"
    real(lines, turned, "line_key").write.parquet(f"{version}/pairs/run=broken")
    assert rows(matches.stored_metrics(lines, segments, table)) == wanted


def test_stream_keeps_areas_of_one_time(spark, tmp_path):
    raw = str(tmp_path / "raw")
    for name in ("east", "west", "east"):
        spark.createDataFrame([(area(name),)], "value string").write.mode("append").text(raw)
    source = stream.unrepeated(stream.snapshot_stream(spark, raw), "60 days")
    stream.to_parquet(stream.clean_stream(source), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.street_name for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["east", "west"]


def test_broken_documents_are_told(spark, tmp_path):
    raw = str(tmp_path / "raw")
    spark.createDataFrame([(area("east"),), ('{"sourceUpdated": "2024-01-01 05:00:00", "results": [{',)], "value string").write.text(raw)
    assert snapshots.broken_documents(spark, raw).count() == 1


def test_command_lines(spark, landed, sf, tmp_path, monkeypatch):
    from roadpulse import jobs as lines

    monkeypatch.setattr(lines, "build_session", lambda *a, **k: spark)
    at = {n: str(tmp_path / n) for n in ("edges", "network", "segments", "silver", "events", "copy", "labels", "labelled")}
    fx.road_edges(spark, sf).withColumn("geometry", geo.to_wkb("geometry")).write.parquet(at["edges"])
    fx.street_labels(spark, sf).write.parquet(at["labels"])
    assert lines.main(["clean", "--raw", landed, "--silver", at["silver"]])["broken_documents"] == 0
    assert lines.main(["roads", "--edges", at["edges"], "--network", at["network"], "--segments", at["segments"]])["road_segments"] > 0
    traffic = ["traffic", "--silver", at["silver"], "--segments", at["segments"], "--events", at["events"], "--events", at["copy"]]
    report = lines.main(traffic)
    assert [lines.main([*traffic, "--matches", str(tmp_path / "matches")]) for _ in range(2)] == [report] * 2
    assert report["final_count"] == spark.read.parquet(at["events"]).count() == spark.read.parquet(at["copy"]).count() > 0
    assert report["candidate_count"] > 0 and report["static_count"] > 0 and report["max_overlap_length"] > 5
    lines.main(["labels", "--silver", at["silver"], "--labels", at["labels"], "--events", at["labelled"]])
    assert spark.read.parquet(at["labelled"]).count() == report["input_count"]
    with pytest.raises(SystemExit):
        lines.main(["traffic", "--silver", at["silver"], "--segments", "db:road_segments", "--events", at["events"]])


def test_overwrite_replaces_only_given_days(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.sql("select * from values (1, 'a'), (2, 'b') as t(n, day)")
    tables.write_parquet(df, path, ["day"])
    tables.write_parquet(spark.sql("select 3 as n, 'b' as day"), path, ["day"])
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [1, 3]
    with pytest.raises(ValueError):
        tables.read_back(spark, path, ["n", "other"])


def test_jdbc_options():
    target = tables.Jdbc("jdbc:postgresql://db/x", "road_segments", "me", "secret", options={"sslmode": "require"})
    assert "secret" not in repr(target)
    write = target.write_options(keep_table=True)
    assert (write["truncate"], write["batchsize"], write["stringtype"], write["sslmode"]) == ("true", "1000", "unspecified", "require")
    assert "truncate" not in target.write_options()
    read = target.read_options("u", (0, 100), 8)
    assert (read["partitionColumn"], read["lowerBound"], read["upperBound"], read["numPartitions"]) == ("u", "0", "100", "8")
    assert tables.segment_subquery("road_segments").startswith("(SELECT segment_id") and "ST_AsBinary(geometry)" in tables.segment_subquery("x")


def test_conform_rejects_missing_columns(spark):
    with pytest.raises(Exception):
        conform(spark.sql("select 'x' as traversability, 'oops' as speed"), "speed struct<a: int>").collect()
    assert conform(spark.sql("select 1 as u, '7' as osmid"), "osmid string, u bigint").dtypes == [("osmid", "string"), ("u", "bigint")]
    assert "geometry binary" in ROAD_EDGES
