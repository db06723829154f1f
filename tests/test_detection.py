import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from logquarry.functions import trees
from logquarry.functions.numbering import numbered, place
from logquarry.functions.quantiles import BUCKETS, exact_quantiles
from logquarry.operators import features, forest, rules
from logquarry.plans import detection, processing, reporting
from logquarry.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES, SCORED_COLUMNS
from logquarry.session import scratch_root
from logquarry.sources import files


def many(make_events, n=300, odd=6):
    """Regular traffic with a few rows that differ in every respect."""
    rows = [
        (f"2025-08-12 14:{i % 60:02d}:00", "INFO", "API_REQUEST", "search", "/find", "GET", 200, 60 + i % 19, f"U{i}", None)
        for i in range(n - odd)
    ]
    rows += [
        (f"2025-08-10 02:{i:02d}:00", "ERROR", "DATABASE_ERROR", None, None, None, 503, 7000 + i, None, None)
        for i in range(odd)
    ]
    return make_events(rows)


@pytest.fixture(scope="module")
def traffic(make_events):
    return many(make_events)


@pytest.fixture(scope="module")
def scored(traffic, kept):
    return detection.score_events(traffic, kept)


def test_features(sample, make_events):
    first = {r["id"]: r for r in features.prepare_features(sample).collect()}
    assert (first[8]["hour"], first[8]["minute_of_hour"], first[8]["day_of_week"]) == (1, 15, 1)  # a Tuesday
    assert [i for i in first if first[i]["is_error"]] == [3, 4, 6]
    assert (first[10]["is_warning"], first[8]["is_auth_failure"], first[6]["is_database_error"]) == (1, 1, 1)
    empty_row = make_events([(None,) * 10])
    r = features.prepare_features(empty_row).first()
    assert [r[c] for c in CATEGORICAL_FEATURES] == ["UNKNOWN"] * 3
    assert [r[c] for c in NUMERIC_FEATURES[2:]] == [0] * 7


def test_profile_and_imputation(sample, no_events, spark):
    p = features.profile(sample)
    assert (p.total, p.rt_median, p.status_median) == (10, 80.0, 403.0)
    assert p.rt_p95 == pytest.approx(np.percentile([40, 20, 700, 900, 3, 60, 500, 100], 95))
    assert tuple(features.profile(no_events)) == (0, None, None, None)
    assert tuple(features.profile_row(p, spark).first()) == tuple(p)
    prepared = features.prepare_features(sample)
    filled = prepared.select("id", *features.impute(prepared, p.literals())).orderBy("id").collect()
    assert [(r["response_time_ms"], r["status"]) for r in filled][4:6] == [(3.0, 403.0), (80.0, 403.0)]


def test_vector(sample, area):
    vectors = features.feature_vector(sample, features.profile(sample).literals(), area).orderBy("id").collect()
    assert {len(r["numbers"]) for r in vectors} == {9}
    # from 9: DEBUG ERROR INFO WARN | API AUTH CACHE DATABASE SERVICE_START | UNKNOWN catalog search shipping
    assert [r["ones"] for r in vectors][:5] == [[12, 13, 19], [11, 13, 19], [10, 13, 21], [10, 13, 21], [11, 15, 18]]
    assert vectors[6]["ones"] == [9, 17, 20]


def test_vocabulary_is_not_gathered(spark, area, make_events):
    rows = [("2025-08-12 14:00:00", "INFO", "API_REQUEST", f"s{i:04d}", *[None] * 6) for i in range(2000)]
    inputs = features.model_inputs(make_events(rows).repartition(7), features.profile(make_events(rows)).literals())
    positions = {r["value"]: r["position"] for r in features.category_positions(inputs, area).where("category = 2").collect()}
    assert positions == {f"s{i:04d}": 11 + i for i in range(2000)}


def test_rules(sample, no_events):
    p95 = F.lit(800.0)
    r = {x["id"]: x for x in rules.rule_signals(sample, p95).withColumn("why", rules.anomaly_reason()).collect()}
    assert [i for i in r if r[i]["high_response_time"]] == [4] and [i for i in r if r[i]["server_error"]] == [3, 4]
    assert r[4]["why"] == "High response time + 5xx server error + Error log level"
    assert r[6]["why"] == "Database error + Error log level"
    assert r[8]["why"] == "Authentication failure" and r[1]["why"] == ""
    every = rules.rule_signals(sample, F.lit(None).cast("double")).where("high_response_time")
    assert every.count() == 0
    model = sample.limit(1).withColumn("ml_prediction", F.lit(-1))
    assert rules.rule_signals(model, p95).select(rules.anomaly_reason(F.col("ml_prediction"))).first()[0] == (
        "Isolation Forest anomaly"
    )


@pytest.mark.parametrize("n", [0, 1, 8, 20])
def test_small_inputs_are_not_scored(make_events, n, area):
    result = detection.score_events(many(make_events, n, 0), area)
    assert result.columns == SCORED_COLUMNS
    assert result.count() == n
    assert result.where("anomaly_score is not null or ml_prediction is not null or is_anomaly").count() == 0


def test_contamination_must_be_a_share(traffic, area):
    with pytest.raises(ValueError, match="contamination"):
        detection.score_events(traffic, area, contamination=0.7)
    assert [forest.minimum_rows(c) for c in (0.05, 0.1, 0.5, 0)] == [21, 11, 3, 3]


def test_scores(traffic, scored):
    rows = scored.toPandas()
    assert len(rows) == 300 and np.isfinite(rows["anomaly_score"]).all()
    assert ((rows["ml_prediction"] == -1) == rows["is_anomaly"]).all()
    assert (rows["is_anomaly"] == (rows["anomaly_score"] < 0)).all()
    assert 1 <= rows["is_anomaly"].sum() <= 15
    odd = rows["event_type"] == "DATABASE_ERROR"
    assert rows.loc[odd, "is_anomaly"].all()
    assert rows.loc[odd, "anomaly_score"].max() < rows.loc[~odd, "anomaly_score"].min()
    assert set(rows.loc[odd, "service"]) == {"UNKNOWN"}
    assert rows.loc[odd, "anomaly_reason"].str.startswith("Isolation Forest anomaly + ").all()


@pytest.mark.parametrize("partitions", [1, 17])
def test_scores_do_not_depend_on_partitioning(traffic, scored, partitions, area):
    again = detection.score_events(traffic.repartition(partitions), area)
    assert again.exceptAll(scored).count() == 0 and again.count() == scored.count()


def test_contamination_sets_the_share(traffic, area):
    flagged = [detection.score_events(traffic, area, c).where("is_anomaly").count() for c in (0.01, 0.2)]
    assert flagged[0] <= 3 and 6 < flagged[1] <= 60


def test_columns_without_values_and_constant_rows(make_events, area):
    rows = [("2025-08-12 14:00:00", "INFO", "USER_LOGIN", None, None, None, None, None, None, None)] * 40
    result = detection.score_events(make_events(rows), area).toPandas()
    assert result["anomaly_score"].eq(0).all() and not result["is_anomaly"].any()


@pytest.mark.parametrize("rows", [100, 20_000, 400_000])
def test_full_sample_for_every_tree(spark, rows):
    """Above and below the size of the pool, and the same under any partitioning."""
    samples = forest.tree_samples(spark.range(rows), rows)
    sizes = samples.groupBy("tree").agg(F.count("*").alias("n"), F.count_distinct("id").alias("d")).collect()
    assert len(sizes) == forest.TREES
    assert all(r["n"] == r["d"] == min(rows, trees.SAMPLE_SIZE) for r in sizes)
    again = forest.tree_samples(spark.range(rows).repartition(13), rows)
    assert again.select("tree", "id").exceptAll(samples.select("tree", "id")).count() == 0


def random_rows(n, seed):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({c: rng.integers(0, 8, n).astype(float) for c in NUMERIC_FEATURES})
    for c in CATEGORICAL_FEATURES:
        frame[c] = rng.choice(["a", "b", "c"], n)
    return frame.assign(id=np.arange(n), draw=rng.random(n))


def test_scores_agree_with_walking_each_tree():
    grown = [trees.grow_tree(random_rows(200, t).assign(tree=t), 42).to_dict("records") for t in range(5)]
    grown = [[{k: None if pd.isna(v) else v for k, v in n.items()} for n in tree] for tree in grown]
    rows = random_rows(50, 99)
    rows.loc[0, "service"] = "never seen"

    def path(tree, row):
        by_node, node = {n["node"]: n for n in tree}, 1
        while by_node[node]["feature"] is not None:
            n = by_node[node]
            value = row[n["feature"]]
            node = 2 * node + int(value == n["category"] if n["category"] is not None else value > n["threshold"])
        return by_node[node]["path"] / 1e6

    expected = [-(2 ** (-np.mean([path(t, r) for t in grown]) / trees.average_path(200)))
                for r in rows.to_dict("records")]
    found = trees.score_rows(
        trees.combine([n for t in grown for n in t], 200), rows[NUMERIC_FEATURES].to_numpy(), [rows[c] for c in CATEGORICAL_FEATURES]
    )
    assert found == pytest.approx(expected)


def test_tree_isolates_and_counts():
    rows = random_rows(256, 1).assign(tree=3)
    one = trees.grow_tree(rows, 42)
    again = trees.grow_tree(rows.sample(frac=1, random_state=5), 42)
    pd.testing.assert_frame_equal(one, again)
    leaves = one[one["feature"].isna()]
    assert leaves["rows"].sum() == 256 and leaves["depth"].max() <= 8 and set(one["node"]) >= {1, 2, 3}
    assert ((one.loc[one["feature"].notna(), "rows"]) > 1).all() and leaves["path"].notna().all()
    inner = one[one["feature"].notna()].set_index("node")
    sizes = one.set_index("node")["rows"]
    assert all(sizes[2 * n] + sizes[2 * n + 1] == r for n, r in inner["rows"].items())  # no side is empty
    assert sizes.min() >= 1
    pair = random_rows(2, 2).assign(tree=0)
    tree = trees.grow_tree(pair, 42)
    assert list(tree["path"].dropna()) == [1_000_000, 1_000_000]
    assert [trees.average_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert trees.average_path(256) == pytest.approx(2 * (math.log(255) + 0.5772156649) - 2 * 255 / 256)


def test_draws_are_those_of_the_columns(spark):
    values = [(3, 17, "service", "a:b", 44), (0, 1, "hour", "at", 7)]
    df = spark.createDataFrame(values, "a int, b int, c string, d string, e int")
    assert [r[0] for r in df.select(trees.uniform(*(F.col(c) for c in "abcde"))).collect()] == [trees.draw(*v) for v in values]


KINDS = {
    "spread": lambda rng: rng.lognormal(0, 4, 3000),
    "ties": lambda rng: rng.integers(0, 5, 3000).astype(float),
    "third": lambda rng: np.where(rng.random(3000) < 0.34, -0.25, -rng.random(3000)),
    "tiny range": lambda rng: 1.0 + rng.integers(0, 4, 3000) * 2.0**-52,
    "two clusters": lambda rng: np.concatenate([rng.random(1500), 1e9 + rng.random(1500)]),
    "wide": lambda rng: np.concatenate([[-1e308, 1e308], rng.random(998) * 1e-300]),
}


@pytest.mark.parametrize("kind", KINDS)
def test_exact_quantiles(spark, kind):
    values = KINDS[kind](np.random.default_rng(3))
    df = spark.createDataFrame(pd.DataFrame({"v": values})).unionByName(spark.sql("select cast(null as double) v"))
    wanted = [0.0, 0.05, 0.5, 0.95, 1.0]
    ordered = np.sort(values)
    for q, found in zip(wanted, exact_quantiles(df, {"v": wanted})["v"]):
        place = q * (len(values) - 1)
        a, b = ordered[math.floor(place)], ordered[math.ceil(place)]
        assert found == a + (b - a) * (place - math.floor(place))


def test_a_median_in_a_gap_gathers_no_more_than_the_buckets(spark, monkeypatch):
    """Both ranks of the median stand at the edges of two clusters, so one pass with few rows answers them."""
    df = spark.createDataFrame(pd.DataFrame({"v": np.concatenate([np.arange(1000.0), 1e7 + np.arange(1000.0)])}))
    collected, plans = [], []
    plain = type(df).collect

    def collect(self):
        rows = plain(self)
        collected.append(len(rows))
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return rows

    monkeypatch.setattr(type(df), "collect", collect)
    assert exact_quantiles(df, {"v": [0.5]}) == {"v": [(999.0 + 1e7) / 2]}
    assert max(collected) <= BUCKETS and not any("Window" in p or "Sort" in p for p in plans)


def scans(df, monkeypatch, run):
    """What ``run`` returns and how often it starts an action on the driver."""
    actions = []
    for name in ("collect", "first"):
        plain = getattr(type(df), name)
        monkeypatch.setattr(type(df), name, lambda self, *a, plain=plain, **b: (actions.append(1), plain(self, *a, **b))[1])
    out = run()
    return out, len(actions)


@pytest.mark.parametrize("kind", KINDS)
def test_few_scans(spark, monkeypatch, kind):
    """A sketch and one or two counting passes, ``first`` being one action that collects."""
    df = spark.createDataFrame(pd.DataFrame({"v": KINDS[kind](np.random.default_rng(7))}))
    _, actions = scans(df, monkeypatch, lambda: exact_quantiles(df, {"v": [0.05, 0.5, 0.95]}))
    assert actions <= 1 + 3  # first() itself calls collect()


def test_profile_needs_three_scans(sample, monkeypatch):
    found, actions = scans(sample, monkeypatch, lambda: features.profile(sample))
    assert found.total == 10 and actions <= 1 + 3


def test_a_sketch_that_misses_is_made_good(spark, monkeypatch):
    from logquarry.functions import quantiles

    values = np.arange(5000.0)
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    plain = quantiles._brackets
    monkeypatch.setattr(quantiles, "_brackets", lambda *a: (plain(*a)[0], {"v": [(4000.0, 4100.0)]}))
    assert exact_quantiles(df, {"v": [0.0, 0.3, 0.5, 1.0]}) == {"v": pytest.approx([0.0, 1499.7, 2499.5, 4999.0])}


def test_quantiles_of_nothing(spark):
    df = spark.sql("select cast(null as double) v, 3 w")
    assert exact_quantiles(df, {"v": [0.5], "w": [0.5]}) == {"v": [None], "w": [3.0]}


def test_numbers_are_dense(spark, area):
    stored = area.store(spark.range(1000, numPartitions=7).where("id % 3 = 0").withColumn("place", place()), "rows")
    found = [r["n"] for r in numbered(stored, "n", 5).collect()]
    assert sorted(found) == list(range(5, 5 + 334))


def test_report(scored, no_events, area):
    (report,) = detection.anomaly_report(scored).collect()
    rows = scored.toPandas()
    flagged = rows[rows["is_anomaly"]]
    assert (report["total_records"], report["anomaly_count"]) == (300, len(flagged))
    assert report["normal_count"] == 300 - len(flagged)
    assert report["anomaly_rate"] == pytest.approx(len(flagged) / 3, abs=0.005)
    assert report["server_error_count"] == rows["server_error"].sum()
    assert report["anomalies_by_service"] == flagged.groupby("service").size().to_dict()
    assert report["anomalies_by_status"] == {str(int(k)): v for k, v in flagged.groupby("status").size().items()}
    (none,) = detection.anomaly_report(detection.score_events(no_events, area)).collect()
    assert none["anomaly_rate"] == 0.0 and none["anomalies_by_event_type"] == {} == none["top_anomalous_endpoints"]


def test_breakdown_limits(spark, make_events):
    rows = [("2025-08-12 14:00:00", "INFO", "API_REQUEST", None if i < 3 else f"s{i:02d}", f"/e{i % 15:02d}", "GET", 200, 1, None, None)
            for i in range(30)]
    flagged = make_events(rows).withColumn("is_anomaly", F.lit(True))
    found = rules.anomaly_breakdowns(flagged).orderBy("dimension", "position").collect()
    services = [r["value"] for r in found if r["dimension"] == "service"]
    assert services == [f"s{i:02d}" for i in range(3, 13)]
    assert len([r for r in found if r["dimension"] == "endpoint"]) == 10
    levels = flagged.withColumn("log_level", F.col("id").cast("string"))
    assert rules.anomaly_breakdowns(levels).where("dimension = 'log_level'").count() == 30


def left_behind(spark):
    """Scratch folders of runs that are over; fixtures keep theirs open."""
    return [n for n in os.listdir(scratch_root(spark)) if n.startswith("run-")]


def test_no_scratch_is_left_behind(spark, tmp_path, make_events):
    before = left_behind(spark)
    events = many(make_events, 40)
    detection.run_detection(events, str(tmp_path))
    reporting.run_analytics(events, str(tmp_path))
    reporting.run_reporting(spark, events, str(tmp_path))
    (tmp_path / "in.log").write_text("junk\n")
    processing.process_logs(spark, str(tmp_path / "in.log"), str(tmp_path / "out"))
    with pytest.raises(ValueError):
        detection.run_detection(events, str(tmp_path), contamination=0.9)
    assert left_behind(spark) == before


def test_saved_detection(spark, traffic, tmp_path):
    result = detection.run_detection(traffic, str(tmp_path))
    saved = files.read_scored(spark, str(tmp_path / "anomalies"))
    assert saved.columns == SCORED_COLUMNS and saved.count() == 300
    assert saved.select("id", "timestamp").exceptAll(traffic.select("id", "timestamp")).count() == 0
    text = spark.read.csv(str(tmp_path / "anomalies"), header=True)
    assert text.where("id = 1").first()["timestamp"] == "2025-08-12 14:00:00"
    assert saved.where("is_anomaly").count() == result.where("is_anomaly").count()
    report = spark.read.json(str(tmp_path / "anomaly_report")).first()
    assert report["anomaly_count"] == result.where("is_anomaly").count()
    assert files.read_scored(spark, str(tmp_path / "none")).count() == 0
