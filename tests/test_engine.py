"""Behaviour of single operators on small frames."""

import datetime as dt
import os
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewright.config import Config
from tracewright.functions import expr as X
from tracewright.logger import get_logger
from tracewright.operators import anomaly, baseline, evaluation, features, graph, scoring, sessions, templates
from tracewright.operators.models import ModelStore
from tracewright.plans import views
from tracewright.plans.latency import run_benchmarks
from tracewright.plans.pipeline import ORDER, Pipeline
from tracewright.sources import logs, sinks
from tracewright.streaming import stream

T0 = dt.datetime(2024, 1, 1)


def frame(spark, offsets, session="s1", template="T", host="h1", first=1, frequency=1):
    rows = [(first + i, T0 + dt.timedelta(seconds=o), session, template if isinstance(template, str) else template[i], frequency, host, "INFO", 0.1) for i, o in enumerate(offsets)]
    return spark.createDataFrame(rows, "sequence_number long, timestamp timestamp_ntz, session_id string, template_id string, frequency long, host string, log_level string, event_weight double")


def values(df, *cols):
    return [tuple(r) for r in df.orderBy("sequence_number").select(*cols).collect()]


def test_slug(spark):
    df = spark.createDataFrame([(["OSPF", "neighbor", "state", "changed"],), (["<*>", "PORT", "DOWN", "<*>"],), (["<*>", "<*>"],)], "t array<string>")
    a, b, c = (r[0] for r in df.select(X.template_slug(F.col("t"))).collect())
    assert (a, b) == ("OSPF_NEIGHBOR_STATE", "PORT_DOWN") and c.startswith("TMPL_")


@pytest.mark.parametrize("line,want", [
    ("<134>2024-03-01 10:00:00 sw1 sshd[12]: login failed for x", ("sw1", "SYSTEM", "ERROR", "login failed for x")),
    ("Mar  1 10:00:00 sw1 OSPF: adjacency lost", ("sw1", "OSPF", "CRITICAL", "adjacency lost")),
    ("<131>Mar  1 10:00:00 sw1 no colon here", ("sw1", "UNKNOWN", "ERROR", "no colon here")),
    ("2024-03-01T10:00:00 sw1 snmpd: WARNING poll slow", ("sw1", "SNMP", "WARN", "poll slow")),
    ("2024-03-01T10:00:00.123 sw1 snmpd: x", None), ("# comment", None), ("", None), ("Feb 30 10:00:00 h a: b", None),
])
def test_normalize(spark, line, want):
    got = logs.parsed_lines(spark.createDataFrame([(line,)], "value string"), year=2024).select("host", "service", "log_level", "message").collect()
    assert [tuple(r) for r in got] == ([want] if want else [])


def test_templates(spark):
    msgs = ["OSPF neighbor state changed to DOWN", "OSPF neighbor state changed to UP", "OSPF neighbor state changed to INIT", "", "  "]
    df = spark.createDataFrame(list(enumerate(msgs, 1)), "sequence_number long, message string")
    got = values(templates.mine_templates(df), "template_id")
    assert got[0] == got[1] == got[2] == ("OSPF_NEIGHBOR_STATE",) and got[3] == got[4] == (templates.EMPTY,)


def test_slug_collision(spark):
    msgs = ["OSPF neighbor state DOWN a b c d e f", "OSPF neighbor state UP 1"]
    got = values(templates.mine_templates(spark.createDataFrame(list(enumerate(msgs, 1)), "sequence_number long, message string")), "template_id")
    assert got[0] == ("OSPF_NEIGHBOR_STATE",) and got[1][0].startswith("OSPF_NEIGHBOR_STATE_") and len(got[1][0]) == 24


@pytest.mark.parametrize("gap,n", [(1801, 2), (1800, 1), (1799, 1)])
def test_session_gap(spark, gap, n):
    got = sessions.sessionize(frame(spark, [0, gap]).drop("session_id")).select("session_id").distinct().collect()
    assert len(got) == n and "h1_20240101T000000" in {r[0] for r in got}


def test_session_over_midnight(spark):
    rows = frame(spark, [86_000, 86_500, 87_000, 90_000]).drop("session_id")
    assert [r[0] for r in values(sessions.sessionize(rows), "session_id")] == ["h1_20240101T235320"] * 3 + ["h1_20240102T010000"]


def test_burstiness_and_times(spark):
    out = features.session_features(frame(spark, [20, 0, 10]))
    assert values(out, "time_delta_prev", "time_delta_session_start", "burstiness_score") == [(10.0, 20.0, 0.0), (0.0, 0.0, 0.0), (10.0, 10.0, 0.0)]
    burst = values(features.session_features(frame(spark, [0, 1, 2, 100, 101])), "burstiness_score")[0][0]
    assert 0 < burst <= 10


def test_ema_matches_recursion(spark):
    gaps = np.random.default_rng(1).integers(1, 500, 300)
    got = [r[0] for r in values(features.session_features(frame(spark, np.cumsum(gaps).tolist())), "inter_arrival_rate")]
    y = 0.0
    for g, have in zip([0, *gaps[1:].tolist()], got):
        y = 0.3 * g + 0.7 * y
        assert abs(y - have) < 1e-9


def test_proximity(spark):
    rows = frame(spark, [0, 5, 40, 86_399], template=["INTERFACE_BANDWIDTH_THRESHOLD", "A", "A", "A"]).union(frame(spark, [0, 86_401], template=["A", "INTERFACE_X_THRESHOLD"], host="h1", first=5)).union(frame(spark, [0], host="h2", first=9))
    got = dict(values(features.counter_proximity(rows), "sequence_number", "counter_proximity"))
    assert got == {1: 1.0, 2: 1 / 6, 3: 0.0, 4: 1 / 3, 5: 1.0, 6: 1.0, 9: 0.0}
    assert features.unmatched_hints(frame(spark, [0, 1], template="PORT_ERROR_THRESHOLD")).count() == 1


def test_rolling_zscore_spike(spark):
    parts = [frame(spark, [i * 10_000], session=f"s{i:02d}", first=i, frequency=3 if i % 2 else 7) for i in range(1, 21)] + [frame(spark, [300_000], session="s99", first=21, frequency=500)]
    df = parts[0]
    for p in parts[1:]:
        df = df.union(p)
    got = values(features.zscore_rolling(df), "zscore_base")
    assert got[0] == (0.0,) and got[-1] == (5.0,)


def test_welford_replay(spark):
    a, b = frame(spark, [0], session="a", frequency=4), frame(spark, [9], session="b", first=2, frequency=10)
    store = spark.createDataFrame([], baseline.STORE)
    for batch in (a, b, a, a.union(b)):
        store = baseline.merge_welford(store, batch)
    r = store.first()
    assert (r["n"], r["welford_mean"], r["welford_M2"], r["seen_session_ids"]) == (2, 7.0, 18.0, ["a", "b"])


def test_forest(spark):
    rows = logs.feature_scenario(spark).selectExpr("*", *[f"0D as {c}" for c in anomaly.FEATURES[3:]], "'t' as template_id")
    forest = anomaly.train_forest(rows)
    again = anomaly.Forest.from_json(forest.to_json())
    out = anomaly.detect(rows, again).join(rows.select("sequence_number", "forced"), "sequence_number").toPandas()
    assert out["combined_score"].between(0, 1).all() and out["isolation_score"].between(0, 1).all()
    assert out.nlargest(20, "isolation_score")["forced"].all()
    assert (out["model_confidence"] == 300 / 500).all()
    assert anomaly.train_forest(rows).to_json() == forest.to_json()
    with pytest.raises(ValueError):
        anomaly.Forest.from_json(forest.to_json().replace('"format": 1', '"format": 9'))


def test_detect_drops_rows_that_are_not_finite(spark):
    rows = logs.feature_scenario(spark, 60, 50).selectExpr("sequence_number", "if(id = 1, double('nan'), frequency_score) as frequency_score".replace("id", "sequence_number"), "burstiness_score", "zscore_base", *[f"0D as {c}" for c in anomaly.FEATURES[3:]])
    assert anomaly.detect(rows).count() == 59


def test_constant_scores(spark):
    rows = spark.range(4).withColumn("raw_isolation", F.lit(0.3))
    out = anomaly.dynamic_threshold(anomaly.minmax_isolation(rows), "isolation_score").collect()
    assert all(r["isolation_score"] == 0.5 and not r["is_anomaly"] for r in out)


def test_retrain_state():
    s = baseline.RetrainState()
    assert not s.absorb(999) and s.absorb(1)
    s.trained()
    assert not s.absorb(999) and baseline.RetrainState.from_json(s.to_json()) == s


def test_pagerank_betweenness():
    w = np.zeros((3, 3))
    w[0, 1] = w[1, 0] = w[1, 2] = w[2, 1] = 1.0
    p = graph.pagerank(w, 0.85)
    assert abs(p.sum() - 1) < 1e-9 and p[1] > p[0]
    assert graph.betweenness(w, np.arange(3)).tolist() == [0.0, 1.0, 0.0]
    assert graph.components(["a", "b", "c", "d"], [("b", "c")]) == {"a": "C0001", "b": "C0000", "c": "C0000", "d": "C0002"}


def test_graph_keeps_sessions_apart(spark):
    rows = frame(spark, [0, 5], session="s1", template=["A", "B"]).union(frame(spark, [0, 5], session="s2", template=["B", "C"], first=3))
    nodes = graph.top_templates(rows)
    assert {(r["a"], r["b"], r["weight"]) for r in graph.edges(rows, nodes).collect()} == {("A", "B", 0.5), ("B", "C", 0.5)}
    scores = graph.graph_scores(rows).toPandas()
    assert scores["in_graph"].all() and set(scores["cluster_id"]) == {"C0000"} and not scores["in_sequence"].any()


def test_sequences_support(spark):
    def sess(k, first):
        return frame(spark, [0, 5, 10], session=f"s{k}", template=["T1", "T2", "T3"], first=first)

    df = sess(0, 1)
    for k in range(1, 6):
        df = df.union(sess(k, 1 + 3 * k))
    assert [r["support_count"] for r in graph.sequences(df).collect()] == [6]
    assert graph.sequences(df.filter("session_id < 's3'")).count() == 0
    assert graph.in_sequence(df).count() == 18


@pytest.mark.parametrize("seed", [0, 1, 2, 3])
def test_dbscan_against_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    n = 60
    x = np.concatenate([rng.normal(c, 0.05, (n // 3, 3)) for c in rng.random((3, 3))]) if seed % 2 else rng.random((n, 3))
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "sequence_number long, final_score double, centrality_score double, temporal_proximity double")
    got = {r[0]: r[1] for r in scoring.dbscan(df).collect()}
    u = (x - x.min(0)) / (x.max(0) - x.min(0))
    near = np.sqrt(((u[:, None] - u[None]) ** 2).sum(2)) <= 0.3
    core = near.sum(1) >= 5
    label, k = [None] * n, 0
    for i in range(n):
        if core[i] and label[i] is None:
            todo = [i]
            while todo:
                v = todo.pop()
                if label[v] is None:
                    label[v] = k
                    todo += [int(w) for w in np.flatnonzero(near[v])] if core[v] else []
            k += 1
    assert got == dict(enumerate(label))


def test_labels_and_fill(spark):
    got = [r[0] for r in spark.createDataFrame([(x,) for x in (0.1, 0.2, 0.35, 0.5, 0.6, 0.75, 0.9)], "s double").select(X.label_of(F.col("s"))).collect()]
    assert got == ["ignore", "ignore", "low", "low", "medium", "medium", "critical"]
    base = spark.createDataFrame([(1,), (2,)], "sequence_number long")
    part = spark.createDataFrame([(1, 0.5, True)], "sequence_number long, v double, flag boolean")
    other = spark.createDataFrame([(1, "C0000")], "sequence_number long, cluster_id string")
    assert values(scoring.merge_scores(base, part, other), "v", "flag", "cluster_id") == [(0.5, True, "C0000"), (0.5, False, "UNCAPPED")]


def test_root_causes(spark):
    rows = [(i, "INC-0000", 0.5 - i / 10, True) for i in range(5)] + [(9, "INC-0000", 0.9, False), (10, None, 0.9, True), (11, "INC-0001", 0.0, False), (12, "INC-0001", 0.0, False)]
    got = scoring.root_causes(spark.createDataFrame(rows, "sequence_number long, correlation_id string, centrality_score double, in_graph boolean")).collect()
    by = {r["sequence_number"]: r["confidence_score"] for r in got}
    assert set(by) == {0, 1, 2, 11, 12} and by[0] == 1.0 and by[11] == 0.5
    assert {r["root_cause_log_id"] for r in got} >= {"log_000000", "log_000011"}


def test_upsert(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k long, s string, v double")
    new = spark.createDataFrame([(2, "z"), (3, "c"), (None, "n")], "k long, s string")
    path = str(tmp_path / "t")
    sinks.write_table(old, path)
    sinks.upsert_table(spark, path, new, ["k"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a", 1.0), (2, "z", 2.0), (3, "c", None)]


def test_confusion_on_empty(spark):
    empty = spark.createDataFrame([], "sequence_number long, is_anomaly boolean")
    truth = spark.createDataFrame([], "sequence_number long, true_label string")
    r = evaluation.confusion(empty, truth).first()
    assert (r["precision"], r["recall"], r["f1"], r["noise_suppression"]) == (0.0, 0.0, 0.0, 0.0)
    assert "precision: 0.0000" in evaluation.text_report(evaluation.confusion(empty, truth))


def test_summary_lists_first_templates(spark):
    rows = frame(spark, list(range(12)), template=[f"T{i}" for i in range(12)]).withColumns({"correlation_id": F.lit("INC-0000"), "label": F.lit("low"), "is_cross_system": F.lit(False)})
    causes = spark.createDataFrame([], "incident_id string, root_cause_log_id string")
    r = views.summary_context(rows, causes).first()
    assert r["sequence"].endswith("T9 ... (+2 more)") and r["root_causes"] == "none"
    assert "12 logs" in views.summarize(views.summary_context(rows, causes)).first()["summary_text"]


def test_pipeline_end_to_end(spark, tmp_path):
    lines = logs.synthetic_lines(spark, hosts=3, events=60).select("value")
    p = Pipeline(spark, str(tmp_path), year=2024)
    assert p.run(dry_run=True) == ORDER
    p.run(lines)
    got = p.summary()
    assert got["sessionized_logs"] == got["features"] == got["anomaly"] == got["graph_scores"] == got["scored_logs"] == 180
    assert Pipeline(spark, str(tmp_path)).run(from_step="scoring") == ["scoring", "storage"]
    with pytest.raises(ValueError):
        p.run(from_step="nothing")
    with pytest.raises(FileNotFoundError):
        Pipeline(spark, str(tmp_path / "none")).run(from_step="features")


def test_streams(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, minute in (("a", 0), ("b", 10), ("c", 600)):
        (folder / f"{name}.log").write_text(f"2024-03-01 {minute // 60:02d}:{minute % 60:02d}:00 sw1 sshd: error {name}\n")
    parsed = stream.parse_stream(stream.read_landing(spark, str(folder), per_trigger=1), year=2024)
    q = stream.stream_sessions(parsed, "10 minutes").writeStream.format("memory").queryName("sess").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["log_count"] for r in spark.table("sess").collect()) == [1, 2]
    store, state = str(tmp_path / "store"), baseline.RetrainState()
    run = stream.baseline_batch(store, state)
    batch = frame(spark, [0, 1], frequency=2)
    run(batch, 0)
    run(batch, 1)
    run(batch, 1)  # a replay
    assert spark.read.parquet(store).first()["n"] == 1 and state.rows == 4


def test_search_documents_and_stage_files(spark, tmp_path):
    rows = spark.createDataFrame([(7, None, float("nan"), None)], "sequence_number long, host string, final_score double, is_anomaly boolean")
    assert tuple(sinks.search_documents(rows).select("log_id", "host", "final_score", "is_anomaly").first()) == ("log_7", "", 0.0, False)
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "x.log").write_text("a\nb\n")
    assert len(logs.stage_files(spark, str(tmp_path / "src"), str(tmp_path / "dst"))) == 1
    assert logs.read_lines(spark, str(tmp_path / "dst")).count() == 2
    with pytest.raises(ValueError):
        logs.require_columns(rows, ["nothing"])
    with pytest.raises(FileNotFoundError):
        logs.read_ground_truth(spark, str(tmp_path))


def test_first_upsert_and_swaps_cut_off(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("k", 1), ("k", 2), (None, 3)], "k string, v int")
    sinks.upsert_table(spark, path, rows, ["k"])
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("k", 2)]
    os.rename(path, path + ".old")  # cut off after the first rename, the new version complete
    sinks.write_table(rows.filter("v = 3").fillna("n"), path + ".new")
    assert [tuple(r) for r in logs.read_table(spark, path).collect()] == [("n", 3)] and not os.path.exists(path + ".old")
    os.rename(path, path + ".old")  # cut off with nothing new
    assert [tuple(r) for r in logs.read_table(spark, path).collect()] == [("n", 3)]


def test_stored_tables(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", 5)], "sequence_number int, host string, other int")
    for day in (1, 2):
        sinks.store(spark, str(tmp_path), "logs", rows.unionByName(rows.withColumn("sequence_number", F.lit(day + 1))), now=datetime(2024, 1, day))
    got = spark.read.parquet(str(tmp_path / "logs"))
    assert got.columns == [c.split()[0] for c in sinks.TABLES["logs"].split(", ")] + ["created_at", "updated_at"]
    assert sorted((r["sequence_number"], r["created_at"].day, r["updated_at"].day) for r in got.collect()) == [(1, 1, 2), (2, 1, 1), (3, 2, 2)]
    assert set(sinks.TABLES) <= set(sinks.KEYS)


def test_numbers_in_file_order(spark, tmp_path):
    sizes = {"a.log": 3, "b.log": 20_000, "c.txt": 500, "d.csv": 9}
    for name, n in sizes.items():
        (tmp_path / name).write_text("".join(f"{name} {i}\n" for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    got = {r["sequence_number"]: r["value"] for r in logs.number_lines(logs.read_lines(spark, str(tmp_path)), F.col("value") != "b.log 7").collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = [f"{name} {i}" for name in ("a.log", "b.log", "c.txt") for i in range(sizes[name]) if f"{name} {i}" != "b.log 7"]
    assert [got[i + 1] for i in range(len(want))] == want and len(got) == len(want)
    assert logs.number_lines(logs.read_lines(spark, str(tmp_path)).limit(0)).count() == 0


def test_confusion_keeps_rows_without_truth(spark, tmp_path):
    rows = spark.createDataFrame([(1, True), (2, True), (3, False)], "sequence_number long, is_anomaly boolean")
    truth = spark.createDataFrame([(1, "anomaly"), (1, "normal")], "sequence_number long, true_label string").coalesce(1)
    r = evaluation.confusion(rows, truth).first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (1, 1, 0, 1)
    scores = rows.withColumns({"combined_score": F.col("sequence_number") / 10, "model_confidence": F.lit(1.0)})
    named = spark.createDataFrame([(1, "A"), (3, "C")], "sequence_number long, template_id string")
    e = evaluation.evaluate(scores, named, truth).first()
    assert e["top_anomalous_templates"] == ["C", None, "A"] and e["count"] == 3 and e["precision"] == 0.5
    text = evaluation.save_report(evaluation.evaluate(scores, named), str(tmp_path / "report.txt"))
    assert (tmp_path / "report.txt").read_text() == text + "\n" and "anomaly_rate: 0.6667" in text
    both = evaluation.labelled_scores(spark.createDataFrame([("log_1", "low", 0.4)], "log_id string, label string, score double"), spark.createDataFrame([("log_1", "critical")], "log_id string, label string"))
    assert both.columns == ["log_id", "label_pred", "score", "label_true"] and both.count() == 1


def test_model_lifecycle(spark, tmp_path, caplog):
    store = ModelStore(spark, str(tmp_path), Config(trees=5, subsample=32, min_train_rows=50, retrain_every=100))
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 7))
    df = spark.createDataFrame([(i, f"s{i // 10}", datetime(2024, 1, 1 + i // 10), *map(float, v)) for i, v in enumerate(x)], "sequence_number long, session_id string, timestamp timestamp, " + ", ".join(f"{c} double" for c in anomaly.FEATURES))
    assert store.load() is None and store.versions() == []
    few = store.detect(df.limit(20)).collect()
    assert len(few) == 20 and {r["model_confidence"] for r in few} == {0.0}
    first = store.detect(df, time="20240101_000000").orderBy("sequence_number").collect()
    assert store.versions() == ["20240101_000000"] and store.state().trained_at == 120
    assert store.maybe_retrain(df) is None
    assert store.load().to_json() == store.load("20240101_000000").to_json() and len(first) == 120
    assert [r["isolation_score"] for r in store.detect(df).orderBy("sequence_number").collect()] == [r["isolation_score"] for r in first]
    newer = store.save(store.load(), "20250101_000000")
    side = tmp_path / f"isolation_forest_v{newer}.json"
    about = side.read_text()
    for bad in (about.replace("zscore_base", "zscore_bass"), about.replace('"numpy": "', '"numpy": "9'), "{"):
        side.write_text(bad)
        (tmp_path / f".isolation_forest_v{newer}.json.crc").unlink(missing_ok=True)
        assert store.load() is None and store.problem(newer)
    side.unlink()
    assert store.problem(newer) == "no sidecar"
    with pytest.raises(FileNotFoundError):
        store.load("19990101_000000")


def test_graph_cache_and_document(spark, tmp_path):
    rows = frame(spark, [0, 10, 20, 30], template=["A", "B", "A", "C"], frequency=1)
    folder = str(tmp_path / "cache")
    nodes, links = graph.cached_graph(rows, folder)
    made = os.stat(folder + "/edges").st_mtime_ns
    again = graph.cached_graph(rows.orderBy(F.desc("sequence_number")), folder)[1]
    assert sorted(again.collect()) == sorted(links.collect()) and os.stat(folder + "/edges").st_mtime_ns == made
    assert graph.fingerprint(rows) != graph.fingerprint(rows.withColumn("template_id", F.lit("Z")))
    assert graph.cached_graph(rows.withColumn("template_id", F.lit("Z")), folder)[0].count() == 1
    nodes, links = graph.cached_graph(rows, folder)
    graph.graph_document(nodes, links, graph.node_scores(nodes, links)).write.text(str(tmp_path / "g.json"))
    n, e = graph.read_graph(spark, str(tmp_path / "g.json"))
    assert {r["id"] for r in n.collect()} == {"A", "B", "C"} and e.count() == 3


def test_summaries_presets_and_search_rows(spark):
    context = spark.createDataFrame([(f"INC-{i}", 3, "h1", 65, "low", "A -> B", "none") for i in range(4)], "correlation_id string, log_count long, hosts string, duration_s long, worst_label string, sequence string, root_causes string")
    stored = spark.createDataFrame([("INC-0", "kept")], "correlation_id string, summary_text string")
    assert views.get_summary(stored, "INC-0") == "kept" and views.get_summary(stored, "INC-1") is None
    mine = lambda df: df.filter("correlation_id <> 'INC-3'").select("correlation_id", F.when(F.col("correlation_id") == "INC-1", "mine").otherwise(" ").alias("summary_text"))
    got = {r[0]: r[1] for r in views.summarize_missing(context, stored, mine).collect()}
    assert set(got) == {"INC-1", "INC-2", "INC-3"} and got["INC-1"] == "mine" and got["INC-2"].startswith("3 logs") and got["INC-3"].startswith("3 logs")
    rows = frame(spark, [0, 3600, 7200])
    last = rows.agg(F.max("timestamp")).first()[0]
    assert [views.recent(rows, h, last).count() for h in (1, 6)] == [2, 3]
    found = sinks.search_rows(spark.createDataFrame([(1, 0.5), (9, 0.1)], "sequence_number long, final_score double"), spark.createDataFrame([(1, "h", 0.9)], "sequence_number long, host string, final_score double"))
    assert sorted(map(tuple, found.collect())) == [(1, 0.5, "h"), (9, 0.1, None)]


def test_latency_harness(spark):
    got = run_benchmarks(spark)
    assert [g["output_rows"] for g in got] == [1_000, 10_000] and all(g["rows_per_second"] > 0 for g in got)


def test_logger(tmp_path, monkeypatch):
    monkeypatch.setenv("LOG_LEVEL", "error")
    path = tmp_path / "x.log"
    for _ in range(2):
        log = get_logger("tracewright.test", str(path))
    log.debug("small thing")
    assert len(log.handlers) == 2 and log.handlers[0].level == 40 and path.read_text().count("small thing") == 1


def test_edges_of_dense_sessions(spark):
    """Pairs against brute force, to both sides of the window's limit; frequencies whose product exceeds a long."""
    rng = np.random.default_rng(4)
    at = [(f"s{k % 3}", f"T{int(t)}", int(us)) for k, (t, us) in enumerate(zip(rng.integers(0, 12, 90), rng.integers(0, 4000, 90)))]
    at += [("edge", "A", 30), ("edge", "B", 90), ("edge", "C", 151), ("odd", "A", None)]
    rows = spark.createDataFrame([(*a, 1) for a in at], "session_id string, template_id string, _s long, frequency long").withColumn("timestamp", F.timestamp_seconds("_s").cast("timestamp_ntz"))
    want = {(s, min(a, b), max(a, b)) for s, a, x in at for s2, b, y in at if s == s2 and a != b and None not in (x, y) and abs(x - y) <= 60}
    assert {tuple(r) for r in graph.session_pairs(rows, graph.top_templates(rows)).collect()} == want and ("edge", "B", "C") not in want
    many = rows.withColumn("frequency", F.lit(1 << 40))
    assert graph.edges(many, graph.top_templates(many)).filter("pmi = 0").count() == len({(a, b) for _, a, b in want})


def test_graph_scores_digest_ids_before_rows_take_them(spark):
    rows = frame(spark, [0, 5, 10, 4000], session="s1", template=["A", "B", "A", "C"])
    lists = {r[0]: ",".join(r[1]) for r in graph.graph_scores(rows).select("sequence_number", "correlated_log_ids").collect()}
    joined = graph.graph_scores(rows, ids=lambda c: F.array_join(c, ",")).select("sequence_number", "correlated_log_ids")
    assert {r[0]: r[1] for r in joined.collect()} == lists == {1: "2", 2: "1,3", 3: "2", 4: ""}


def test_graph_scores_hold_all_templates(spark):
    """No template is cut from a graph of more than the former limit; sparse ranks equal dense ones."""
    from tracewright.plans import queries as Q

    n = graph.DEFAULT.graph_max_nodes + 20
    rows = spark.range(2 * n).select((F.col("id") + 1).alias("sequence_number"), F.concat(F.lit("s"), F.floor(F.col("id") / 2)).alias("session_id"), F.concat(F.lit("T"), F.floor((F.col("id") + 1) / 2)).alias("template_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("timestamp"), F.lit(1).cast("long").alias("frequency"))
    got = graph.graph_scores(rows).toPandas()
    assert got["in_graph"].all() and set(got["cluster_id"]) == {"C0000"} and (got["degree"] > 0).all()
    assert Q.SQL["pagerank"].count("LIMIT") == Q.SQL["graph_scores"].count("LIMIT") == 0 and "LIMIT 500" in Q.SQL["edge_pmi"]
    w = np.triu(np.random.default_rng(1).random((9, 9)) * (np.random.default_rng(2).random((9, 9)) < 0.4), 1)
    w = w + w.T
    p, out = np.full(9, 1 / 9), w.sum(1)
    for _ in range(100):
        p = 0.85 * (np.where(out > 0, p / np.where(out > 0, out, 1), 0) @ w + p[out == 0].sum() / 9) + 0.15 / 9
    assert np.allclose(graph.pagerank(w, 0.85), p, rtol=0, atol=1e-14)


def test_equal_ranks(spark):
    rows = frame(spark, [0, 5], session="s1", template=["A", "B"])
    nodes = graph.top_templates(rows)
    ranks = lambda **k: [r["pagerank"] for r in graph.node_scores(nodes, graph.edges(rows, nodes), **k).collect()]
    assert ranks() == [0.5, 0.5] and all(x is not None and np.isnan(x) for x in ranks(flat=float("nan")))


def test_scores_of_equal_rows(spark):
    """Equal raw scores: 0.5 by the contract, not a number where the SQL divides by zero; no fixed threshold there."""
    rows = spark.createDataFrame([(i, 0.4, 0.0) for i in range(4)], "sequence_number long, raw_isolation double, zscore_base double")
    assert [r[0] for r in anomaly.minmax_isolation(rows).select("isolation_score").collect()] == [0.5] * 4
    odd = anomaly.combine(anomaly.minmax_isolation(rows, float("nan")), 400)
    got = anomaly.dynamic_threshold(odd, fixed=False).select("isolation_score", "combined_score", "is_anomaly").collect()
    assert all(np.isnan(r[0]) and r[1] == 1.0 and not r[2] for r in got) and len(got) == 4


def test_cells_are_linked_by_boxes(spark):
    """Dense cells on both sides of a gap of 0.3001, of which only parts are compared by points."""
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.random((300, 3)) * (0.2999, 1, 1), rng.random((300, 3)) * (0.3, 1, 1) + (0.6002, 0, 0), [[0.3, 0.5, 0.5], [0.6001, 0.5, 0.5]]])
    at = spark.createDataFrame([(i, *map(float, v), "1,0,0" if v[0] <= 0.3 else "3,0,0") for i, v in enumerate(x)], "sequence_number long, x double, y double, z double, cell string")
    for eps, want in ((0.30005, []), (0.30015, [("1,0,0", "3,0,0")])):
        assert list(scoring._linked(at, [("1,0,0", "3,0,0")], eps, lambda a, b: False)) == want


def test_folding_against_one_pass(spark):
    """Clusters against a plain pass over every bucket, full buckets and repeated messages included."""
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{int(v)}" for v in rng.integers(0, 4, 4)) for _ in range(400)]
    from collections import defaultdict
    buckets, owner = defaultdict(list), []
    for t in texts:
        w = t.split()
        own = buckets[w[0]]
        score = [sum(a in (b, "<*>") for a, b in zip(c, w)) / 4 for c in own]
        best = int(np.argmax(score)) if own else -1
        if own and score[best] >= 0.75:
            own[best][:] = [a if a == b else "<*>" for a, b in zip(own[best], w)]
            owner.append(own[best])
        elif len(own) < 3:
            own.append(list(w))
            owner.append(own[-1])
        else:
            owner.append(w)
    df = spark.createDataFrame(list(enumerate(texts, 1)), "sequence_number long, message string")
    got = {r[0]: r[1] for r in templates.mine_templates(df, Config(sim_threshold=0.75, max_children=3)).select("sequence_number", "template").collect()}
    assert [got[i] for i in range(1, 401)] == [" ".join(o) for o in owner] and not hasattr(templates, "pd")
