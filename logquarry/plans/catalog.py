"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame over the whole given tables."""

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logquarry.functions import hashing
from logquarry.functions.timestamps import log_text, micros_text
from logquarry.operators import analytics, facets, forest, load, parse, quality, reports, rules, validate
from logquarry.operators import features as feature_ops
from logquarry.plans import detection, processing, reporting
from logquarry.schema import ANALYSIS_COLUMNS, CATEGORICAL_FEATURES, NULL_TOKENS, RECORD_COLUMNS, RULE_SIGNALS
from logquarry.session import Scratch, gathered, session_area, use_scratch
from logquarry.sources import events as derived
from logquarry.sources import files, rollups, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _register(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_scratch(spark)
        return query(spark, sf_dir)

    QUERIES[query.__name__] = run
    return run


def _fact_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return analytics.FACT_QUERIES[name](analytics.facts(derived.log_events(spark, sf_dir)))

    return run


QUERIES.update({name: _fact_query(name) for name in analytics.FACT_QUERIES})


@_register
def user_activity_summary(spark, sf_dir):
    return analytics.user_activity_summary(derived.log_events(spark, sf_dir))


@_register
def analytics_report(spark, sf_dir):
    """All thirteen results, computed the way a full report does: from the stored roll-up."""
    events = derived.log_events(spark, sf_dir)
    return reporting.measures(analytics.all_analytics(events, reporting.stored_summary(events, session_area(spark))))


# --- text sources, parsing, validation -------------------------------------------------------------


def _document_lines(spark, sf_dir):
    text = F.split("text", "\r\n|[\r\n]", -1)
    return derived.read_table(spark, sf_dir, "documents").select("doc_id", F.explode(text).alias("value"))


@_register
def ingest_lines(spark, sf_dir):
    return files.log_lines(_document_lines(spark, sf_dir))


@_register
def ingest_stats(spark, sf_dir):
    return files.ingest_stats(_document_lines(spark, sf_dir))


@_register
def reject_free_text(spark, sf_dir):
    """Why lines of ordinary documents are not log lines."""
    records = parse.parse_lines(files.log_lines(_document_lines(spark, sf_dir)))
    return parse.rejected_only(records).groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("line_count"))


@_register
def log_lines(spark, sf_dir):
    return parse.format_lines(derived.log_events(spark, sf_dir))


def _narrow(records: DataFrame, *columns: str) -> DataFrame:
    """Parsed numbers have up to 38 digits; those of the given tables are bigints."""
    return records.withColumns({c: F.col(c).cast("bigint") for c in columns})


@_register
def parse_logs(spark, sf_dir):
    return _narrow(parse.parsed_only(parse.parse_lines(derived.raw_lines(spark, sf_dir))), "status", "response_time_ms")


@_register
def parse_numbers(spark, sf_dir):
    """Statuses and times in every accepted spelling, and some that are not, parsed and validated."""
    row, digits = F.col("id"), "0123456789"
    status = F.coalesce("status", F.lit(200)).cast("string")
    time = F.coalesce("response_time_ms", F.lit(5)).cast("string")
    statuses = (
        F.when(row % 7 == 1, F.concat(F.lit("+"), status))
        .when(row % 7 == 2, F.concat(F.substring(status, 1, 1), F.lit("_"), F.substring(status, 2, 9)))
        .when(row % 7 == 3, F.translate(status, digits, "٠١٢٣٤٥٦٧٨٩"))
        .when(row % 7 == 4, F.concat(status, F.lit("0" * 25)))
        .when(row % 7 == 5, "2__0")
        .when(row % 7 == 6, F.concat(F.lit("00"), status))
        .otherwise(status)
    )
    times = (
        F.when(row % 5 == 1, "-0")
        .when(row % 5 == 2, "123456789012345678901")
        .when(row % 5 == 3, F.translate(time, digits, "०१२३४५६७८९"))
        .when(row % 5 == 4, "-7")
        .otherwise(time)
    )
    head = F.lit("2025-07-14 06:05:04,030 | INFO | API_REQUEST | service=search | status=")
    line = F.concat(head, statuses, F.lit(" | response_time_ms="), times)
    routed = processing.routed_records(derived.log_events(spark, sf_dir).select("id", line.alias("line")))
    valid = F.col("outcome") == validate.VALID
    return routed.select(
        "id", "status", F.when(valid, F.col("response_time_ms").cast("string")).alias("response_time_ms"), "rejection_reason", "outcome"
    )


@_register
def rejected_logs(spark, sf_dir):
    return validate.all_rejections(processing.routed_records(derived.raw_lines(spark, sf_dir)))


@_register
def validate_records(spark, sf_dir):
    return validate.invalid_records(processing.routed_records(derived.raw_lines(spark, sf_dir)))


def _cleaned(spark, sf_dir):
    return validate.deduplicate(validate.valid_records(processing.routed_records(derived.raw_lines(spark, sf_dir))))


@_register
def dedupe_records(spark, sf_dir):
    return _narrow(_cleaned(spark, sf_dir), "response_time_ms")


@_register
def validate_structured(spark, sf_dir):
    """All errors of structured records, several on some: missing fields, statuses and times out of range."""
    row = F.col("id")
    damaged = derived.log_events(spark, sf_dir).withColumns(
        {
            "timestamp": F.when(row % 6 != 1, F.col("timestamp")),
            "log_level": F.when(row % 10 != 1, F.col("log_level")),
            "event_type": F.when(row % 14 != 3, F.col("event_type")),
            "service": F.when(row % 4 != 1, F.col("service")),
            "status": F.when(row % 9 == 1, F.lit(99)).when(row % 9 == 2, F.lit(600)).otherwise(F.col("status")),
            "response_time_ms": F.when(row % 8 == 1, -row.cast("int") - 1).otherwise(F.col("response_time_ms")),
        }
    )
    errors = validate.validation_errors(damaged)
    return damaged.select("id", errors.alias("errors")).where(F.col("errors") != "")


def _stage_counts(spark, sf_dir):
    with Scratch(spark) as area:
        routed = processing.store_routed(processing.routed_records(derived.raw_lines(spark, sf_dir)), area)
        counts = processing.stage_counts(routed, validate.deduplicate(validate.valid_records(routed)).count())
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} bigint" for c in counts))


@_register
def duplicate_count(spark, sf_dir):
    return _stage_counts(spark, sf_dir).select("duplicate_records")


@_register
def cleaned_rows(spark, sf_dir):
    return files.cleaned_rows(dedupe_records(spark, sf_dir))


@_register
def processing_stats(spark, sf_dir):
    return _stage_counts(spark, sf_dir)


def _raw_files(spark, sf_dir, area: Scratch) -> str:
    """The raw lines as text files; every two-hundredth is followed by a blank line."""
    lines = derived.raw_lines(spark, sf_dir)
    blank = F.when((F.col("id") % 200 == 0) & (F.col("copy") == 0), F.array(F.col("line"), F.lit("  ")))
    path = area.path("raw")
    lines.select(F.explode(F.coalesce(blank, F.array("line"))).alias("value")).write.text(path)
    return path


@_register
def cleaned_round_trip(spark, sf_dir):
    """Raw files processed to cleaned files, which are read back as text."""
    area = session_area(spark)
    out = area.path("out")
    processing.process_logs(spark, _raw_files(spark, sf_dir, area), out)
    return files.read_cleaned(spark, f"{out}/cleaned_logs").select(*RECORD_COLUMNS)


@_register
def rejected_round_trip(spark, sf_dir):
    area = session_area(spark)
    out = area.path("out")
    processing.process_logs(spark, _raw_files(spark, sf_dir, area), out)
    return files.read_rejected(spark, f"{out}/rejected_logs")


@_register
def process_and_load(spark, sf_dir):
    """Raw files processed, and the cleaned ones loaded twice into a new table: every count on the way."""
    name = f"load_{uuid.uuid4().hex}"
    with Scratch(spark) as area:
        out = area.path("out")
        counts = [("processing", k, v) for k, v in processing.process_logs(spark, _raw_files(spark, sf_dir, area), out).items()]
        try:
            table.create_table(spark, name, 8, area.path("table"))
            for load in ("first load", "second load"):
                counts += [(load, k, v) for k, v in table.load_csv(spark, f"{out}/cleaned_logs", name).items()]
            events = table.load_log_data(spark, name)
            ids = events.agg(F.count_distinct("id").alias("distinct_ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id")).first()
            counts += [("table", k, v) for k, v in ids.asDict().items()]
            found = table.verify_table(spark, name).first()
            counts += [("table", "total_rows", found["total_rows"])]
            counts += [("level", r["log_level"], r["event_count"]) for r in found["level_counts"]]
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.createDataFrame(counts, "part string, measure string, value bigint")


# --- loading ---------------------------------------------------------------------------------------


def _csv_text(spark, sf_dir):
    """Log events as CSV text in every accepted spelling, chosen by id."""
    row = F.col("id")
    token = F.element_at(F.array(*[F.lit(t) for t in NULL_TOKENS]), (row % len(NULL_TOKENS) + 1).cast("int"))

    def number(name):
        text = F.col(name).cast("string")
        underscored = F.concat(F.substring(text, 1, 1), F.lit("_"), F.expr(f"substring(cast({name} as string), 2)"))
        return (
            F.when(text.isNull(), token)
            .when(row % 4 == 1, F.concat(text, F.lit(".0")))
            .when(row % 4 == 2, F.concat(F.lit(" "), text, F.lit(" ")))
            .when(row % 4 == 3, F.concat(text, F.lit(".9")))
            .when((row % 7 == 3) & (F.length(text) > 1), underscored)
            .otherwise(text)
        )

    seconds = F.concat(F.lit("  "), F.substring(log_text(F.col("timestamp")), 1, 19), F.lit(" "))
    texts = {
        "timestamp": F.when(row % 3 == 0, log_text(F.col("timestamp")))
        .when(row % 3 == 1, micros_text(F.col("timestamp")))
        .otherwise(seconds),
        "status": number("status"),
        "response_time_ms": F.when(row % 97 == 13, "abc").otherwise(number("response_time_ms")),
    }
    for c in RECORD_COLUMNS:
        if c not in texts:
            padded = F.when(row % 2 == 1, F.concat(F.lit(" "), F.col(c), F.lit("\t"))).otherwise(F.col(c))
            texts[c] = F.coalesce(padded, token)
    return derived.log_events(spark, sf_dir).select("id", *[texts[c].alias(c) for c in RECORD_COLUMNS])


@_register
def csv_typing(spark, sf_dir):
    return load.type_rows(_csv_text(spark, sf_dir)).select("id", *RECORD_COLUMNS, "row_error")


def _damaged_rows(spark, sf_dir):
    k = F.col("id") % 11
    damaged = (
        F.when(k == 5, "not-a-date")
        .when(k == 6, "2024-02-30 10:00:00")
        .when(k == 7, "   ")
        .when(k == 8, "NaT")
        .otherwise(F.col("timestamp"))
    )
    status = F.when(k == 9, "inf").when(k == 10, "3e9").otherwise(F.col("status"))
    return load.type_rows(_csv_text(spark, sf_dir).withColumns({"timestamp": damaged, "status": status}))


@_register
def csv_row_errors(spark, sf_dir):
    """Rows that would make a load fail, with the reason."""
    return _damaged_rows(spark, sf_dir).where(F.col("row_error").isNotNull()).select("id", "row_error")


@_register
def refused_load(spark, sf_dir):
    """A load with bad rows after a good one: the message, and the table as the good one left it."""
    order = {"file": F.lit(""), "block": F.lit(0), "row": F.col("id")}
    name = f"load_{uuid.uuid4().hex}"
    with Scratch(spark) as area:
        try:
            table.create_table(spark, name, 8, area.path("table"))
            table.load_rows(spark, derived.hashed_log_events(spark, sf_dir).withColumns(order), name)
            message = None
            try:
                table.load_rows(spark, _damaged_rows(spark, sf_dir).withColumns(order), name)
            except ValueError as refusal:
                message = str(refusal)
            found = table.log_events(spark, name).agg(F.count(F.lit(1)), F.max("id")).first()
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.createDataFrame([(message, *found)], "message string, total_rows bigint, last_id bigint")


@_register
def record_hash(spark, sf_dir):
    return derived.hashed_log_events(spark, sf_dir).select("id", "record_hash")


def _second_load(spark, sf_dir):
    """Target and incoming rows of a repeated load.

    The target holds the records cleaned from the raw lines. Incoming are all log events, each twice,
    the second time in capitals, which hashes alike.
    """
    target = _narrow(_cleaned(spark, sf_dir), "response_time_ms").withColumn("record_hash", hashing.record_hash())
    first = derived.log_events(spark, sf_dir).withColumn("copy", F.lit(0))
    capitals = first.withColumns(
        {f.name: F.upper(f.name) for f in first.schema.fields if f.dataType.typeName() == "string"}
    ).withColumn("copy", F.lit(1))
    return target, first.unionByName(capitals).withColumn("record_hash", hashing.record_hash())


@_register
def idempotent_load(spark, sf_dir):
    """Rows that the second load inserts."""
    target, incoming = _second_load(spark, sf_dir)
    return load.absent_from(load.first_per_hash(incoming, ["id", "copy"]), target)


@_register
def load_stats(spark, sf_dir):
    """Counts of the second load, through the table itself."""
    target, incoming = _second_load(spark, sf_dir)
    row = F.monotonically_increasing_id()
    order = {"file": F.lit(""), "block": F.lit(0), "row": row, "response_time_ms": F.col("response_time_ms").cast("int")}
    name = f"load_{uuid.uuid4().hex}"
    with Scratch(spark) as area:
        try:
            table.create_table(spark, name, 8, area.path("table"))
            table.load_rows(spark, target.withColumns(order), name)
            in_order = order | {"file": F.col("copy").cast("string"), "row": F.col("id") * 2 + F.col("copy")}
            counts = table.load_rows(spark, incoming.withColumns(in_order), name)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} bigint" for c in counts))


@_register
def table_analytics(spark, sf_dir):
    """The thirteen results over a table that grew between two refreshes of its daily roll-ups."""
    row = F.monotonically_increasing_id()
    events = derived.hashed_log_events(spark, sf_dir).withColumns({"file": F.lit(""), "block": F.lit(0), "row": row})
    name, area = f"load_{uuid.uuid4().hex}", session_area(spark)
    try:
        table.create_table(spark, name, 8, area.path("table"))
        for part in ("id % 3 > 0", "id % 3 = 0"):
            table.load_rows(spark, events.where(part), name)
            rollups.refresh(spark, name)
        return area.store(reporting.measures(rollups.table_analytics(spark, name)), "measures")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@_register
def constraint_violations(spark, sf_dir):
    k = F.col("id") % 13
    rows = derived.hashed_log_events(spark, sf_dir).withColumns(
        {
            "log_level": F.when(k == 1, F.lower("log_level")).otherwise(F.col("log_level")),
            "status": F.when(k == 2, 700).otherwise(F.col("status")),
            "response_time_ms": F.when(k == 3, -1).otherwise(F.col("response_time_ms")),
            "service": F.when(k == 4, F.repeat(F.lit("s"), 31)).otherwise(F.col("service")),
            "timestamp": F.when(k != 5, F.col("timestamp")),
            "event_type": F.when(k != 6, F.col("event_type")),
        }
    )
    return load.constraint_violations(rows)


@_register
def load_verify(spark, sf_dir):
    return load.load_summary(derived.log_events(spark, sf_dir)).select(
        "total_rows", "min_timestamp", "max_timestamp", F.inline("level_counts")
    )


# --- anomaly detection -----------------------------------------------------------------------------


@_register
def response_time_profile(spark, sf_dir):
    return feature_ops.profile_row(feature_ops.profile(derived.log_events(spark, sf_dir)), spark)


@_register
def features(spark, sf_dir):
    events = derived.log_events(spark, sf_dir)
    prepared = feature_ops.prepare_features(events)
    return prepared.select("id", *feature_ops.impute(prepared, feature_ops.profile(events).literals()), *CATEGORICAL_FEATURES)


@_register
def feature_vector(spark, sf_dir):
    """The sparse vector: two of its numbers and the three positions that hold a 1."""
    events = derived.log_events(spark, sf_dir)
    vectors = feature_ops.feature_vector(events, feature_ops.profile(events).literals(), session_area(spark))
    return vectors.select(
        "id",
        F.get("numbers", F.lit(0)).alias("response_time_ms"),
        F.get("numbers", F.lit(1)).alias("status"),
        *[F.get("ones", F.lit(i)).alias(f"{c}_position") for i, c in enumerate(CATEGORICAL_FEATURES)],
    )


def _with_rules(spark, sf_dir):
    events = derived.log_events(spark, sf_dir).select(*ANALYSIS_COLUMNS)
    filled = events.withColumns({c: F.coalesce(c, F.lit(feature_ops.UNKNOWN)) for c in CATEGORICAL_FEATURES})
    signals = rules.rule_signals(filled, feature_ops.profile(events).literals()["rt_p95"])
    return signals.withColumn("anomaly_reason", rules.anomaly_reason())


@_register
def rule_signals(spark, sf_dir):
    return _with_rules(spark, sf_dir).select("id", *RULE_SIGNALS)


@_register
def anomaly_reason_rules(spark, sf_dir):
    return _with_rules(spark, sf_dir).select("id", "anomaly_reason")


def _flagged_by_rules(spark, sf_dir):
    """Any fired rule stands in for the model's decision, so that SQL can follow the totals."""
    return _with_rules(spark, sf_dir).withColumn("is_anomaly", F.col("anomaly_reason") != "")


@_register
def rule_anomaly_totals(spark, sf_dir):
    return rules.anomaly_totals(_flagged_by_rules(spark, sf_dir))


@_register
def rule_anomaly_breakdowns(spark, sf_dir):
    return rules.anomaly_breakdowns(_flagged_by_rules(spark, sf_dir))


@_register
def rule_anomaly_list(spark, sf_dir):
    return facets.anomalous_events(_flagged_by_rules(spark, sf_dir))


@_register
def contamination_threshold(spark, sf_dir):
    """The decision rule on a score that SQL can compute: slower is more anomalous."""
    events = derived.log_events(spark, sf_dir)
    score = -F.coalesce("response_time_ms", F.lit(0)).cast("double")
    decided = forest.decide(events.select("id", score.alias("model_score")), forest.CONTAMINATION)
    return decided.withColumn("anomaly_score", F.round("anomaly_score", 6))


@_register
def forest_samples(spark, sf_dir):
    """The events each tree of the forest grows from."""
    events = derived.log_events(spark, sf_dir)
    return forest.tree_samples(events.select("id"), events.count()).select("tree", "id")


@_register
def forest_nodes(spark, sf_dir):
    """Every node of every tree, with its split or its path length."""
    events = derived.log_events(spark, sf_dir)
    found = feature_ops.profile(events)
    return forest.forest_nodes(feature_ops.model_inputs(events, found.literals()), found.total)


def _scored(spark, sf_dir, contamination=forest.CONTAMINATION):
    return detection.score_events(derived.log_events(spark, sf_dir), session_area(spark), contamination)


def _rounded(scored):
    """Six places of the score; adding zero drops the sign of a zero."""
    return scored.withColumn("anomaly_score", F.round("anomaly_score", 6) + 0.0)


@_register
def isolation_forest_scores(spark, sf_dir):
    return _rounded(_scored(spark, sf_dir))


@_register
def forest_properties(spark, sf_dir):
    """What must hold for the scores of any forest, counted over all events."""
    score, flag = F.col("anomaly_score"), F.col("is_anomaly")
    consistent = flag.eqNullSafe(score < 0) & flag.eqNullSafe(F.col("ml_prediction") == -1)
    reason = F.col("anomaly_reason").startswith(rules.MODEL_REASON)
    counted = _scored(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("id").alias("ids"),
        F.count_if(score.isNull() | F.isnan(score)).alias("missing_scores"),
        F.count_if(~consistent).alias("disagreements"),
        F.count_if(reason != flag).alias("wrong_reasons"),
        F.count_if(flag).alias("flagged"),
    )
    # at most the share of rows lies strictly below its quantile; ties at the quantile are not flagged
    within = (F.col("flagged") > 0) & (F.col("flagged") <= F.ceil(F.col("rows") * forest.CONTAMINATION))
    return counted.select("*", within.alias("flagged_within_share")).drop("flagged")


@_register
def anomaly_summary(spark, sf_dir):
    return rules.anomaly_totals(_scored(spark, sf_dir))


@_register
def anomaly_breakdowns(spark, sf_dir):
    return rules.anomaly_breakdowns(_scored(spark, sf_dir))


@_register
def anomalous_events(spark, sf_dir):
    return facets.anomalous_events(_rounded(_scored(spark, sf_dir)))


@_register
def saved_detection(spark, sf_dir):
    """A whole detection run: the scored events as saved in CSV and read back."""
    out = session_area(spark).path("out")
    return _rounded(detection.run_detection(derived.log_events(spark, sf_dir), out))


@_register
def saved_detection_report(spark, sf_dir):
    """The totals of the same run as saved in JSON."""
    with Scratch(spark) as area:
        out = area.path("out")
        detection.run_detection(derived.log_events(spark, sf_dir), out)
        saved = files.read_report(spark, f"{out}/anomaly_report", reports.ANOMALY_REPORT_SCHEMA)
        return gathered(saved.drop(*reports.BREAKDOWN_MAPS))


UNREACHED = 1e-9  # a share of anomalies that asks for more rows than any given table has


@_register
def guarded_detection(spark, sf_dir):
    """Detection without a model, for want of rows: saved as CSV and read back."""
    out = session_area(spark).path("out")
    return detection.run_detection(derived.log_events(spark, sf_dir), out, UNREACHED)


@_register
def saved_anomaly_report(spark, sf_dir):
    """The totals of the same run as saved in JSON."""
    with Scratch(spark) as area:
        out = area.path("out")
        detection.run_detection(derived.log_events(spark, sf_dir), out, UNREACHED)
        saved = files.read_report(spark, f"{out}/anomaly_report", reports.ANOMALY_REPORT_SCHEMA)
        return gathered(saved.drop(*reports.BREAKDOWN_MAPS))


# --- quality, reports, views -----------------------------------------------------------------------


def _quality(spark, sf_dir):
    return quality.measurements(derived.log_events(spark, sf_dir))


@_register
def quality_checks(spark, sf_dir):
    return quality.quality_checks(_quality(spark, sf_dir))


@_register
def quality_score(spark, sf_dir):
    return quality.quality_report(_quality(spark, sf_dir)).drop("checks")


def _no_anomaly_report(spark):
    return spark.createDataFrame([], reports.ANOMALY_REPORT_SCHEMA)


def _flagged_report(spark, sf_dir):
    """The anomaly report of events flagged by any rule."""
    return gathered(detection.anomaly_report(_flagged_by_rules(spark, sf_dir)))


def _operational(spark, sf_dir, anomalies=None):
    with Scratch(spark) as area:
        summary = reporting.stored_summary(derived.log_events(spark, sf_dir), area)
        return gathered(reports.operational_report(summary, _no_anomaly_report(spark) if anomalies is None else anomalies))


def _metrics(report):
    """Single figures of the operational report."""
    return report.select(*[f.name for f in report.schema.fields if f.dataType.typeName() not in ("array", "map", "struct")])


@_register
def operational_metrics(spark, sf_dir):
    """Single figures of the operational report when no detection has run."""
    return _metrics(_operational(spark, sf_dir))


@_register
def flagged_operational_metrics(spark, sf_dir):
    return _metrics(_operational(spark, sf_dir, _flagged_report(spark, sf_dir)))


@_register
def flagged_operational_maps(spark, sf_dir):
    """The anomaly breakdowns inside the operational report, one row per entry."""
    report = _operational(spark, sf_dir, _flagged_report(spark, sf_dir))
    maps = [c for c in reports.BREAKDOWN_MAPS if c in report.columns]
    entries = [report.select(F.lit(c).alias("section"), F.explode(c).alias("value", "event_count")) for c in maps]
    return functools.reduce(DataFrame.unionByName, entries)


@_register
def operational_sections(spark, sf_dir):
    """Lists of the operational report, one row per entry."""
    report = _operational(spark, sf_dir)
    shapes = {
        "log_level_distribution": ("log_level", "event_count", "pct"),
        "event_type_distribution": ("event_type", "event_count", "pct"),
        "slowest_endpoints": ("endpoint", "request_count", "avg_response_time_ms"),
        "busiest_endpoints": ("endpoint", "request_count", "avg_response_time_ms"),
        "service_performance": ("service", "total_count", "avg_response_time_ms"),
    }

    def entries(section: str, label: str, count: str, value: str):
        def entry(e, i):
            return F.struct(
                F.lit(section).alias("section"),
                (i + 1).alias("position"),
                e[label].alias("label"),
                e[count].alias("event_count"),
                e[value].alias("value"),
            )

        return F.transform(section, entry)

    return report.select(F.inline(F.concat(*[entries(section, *shape) for section, shape in shapes.items()])))


@_register
def top_findings(spark, sf_dir):
    return reports.top_findings(_operational(spark, sf_dir))


@_register
def flagged_findings(spark, sf_dir):
    """All five findings, as events flagged by rules have anomalies."""
    return reports.top_findings(_operational(spark, sf_dir, _flagged_report(spark, sf_dir)))


@_register
def kpi_row(spark, sf_dir):
    return reports.kpi_row(_operational(spark, sf_dir), quality.quality_report(_quality(spark, sf_dir)))


@_register
def flagged_kpi_row(spark, sf_dir):
    operational = _operational(spark, sf_dir, _flagged_report(spark, sf_dir))
    return reports.kpi_row(operational, quality.quality_report(_quality(spark, sf_dir)))


def _built(spark, sf_dir, anomalies):
    with Scratch(spark) as area:
        return reporting.combined_reports(derived.log_events(spark, sf_dir), anomalies, area)


@_register
def final_report(spark, sf_dir):
    """The whole document, detection included."""
    with Scratch(spark) as area:
        events = derived.log_events(spark, sf_dir)
        anomalies = detection.anomaly_report(detection.score_events(events, area))
        return reporting.combined_reports(events, anomalies, area)["final"]


@_register
def final_report_figures(spark, sf_dir):
    """The document on events flagged by rules, without the time of the run, one row per figure or finding."""
    final = _built(spark, sf_dir, _flagged_report(spark, sf_dir))["final"]
    listed = [F.struct(F.concat(F.lit("finding "), (i + 1).cast("string")).alias("name"), F.get("top_findings", i).alias("value")) for i in map(F.lit, range(5))]
    for part in ("dataset", "data_quality", "operational_metrics", "anomaly_detection"):
        for field in final.schema[part].dataType.fields:
            if field.dataType.typeName() not in ("array", "map", "struct"):
                listed.append(F.struct(F.lit(f"{part}.{field.name}").alias("name"), F.col(f"{part}.{field.name}").cast("string").alias("value")))
    return final.select(F.inline(F.array(*listed))).where(F.col("value").isNotNull())


@_register
def text_report(spark, sf_dir):
    """The text report when no detection has run, without the line that holds the time of the run."""
    built = _built(spark, sf_dir, _no_anomaly_report(spark))
    return reports.text_report(built["final"]).where(~F.col("line").startswith("Generated: "))


@functools.cache
def _reports_of(application_id: str, sf_dir: str) -> dict[str, str]:
    spark = SparkSession.active()
    return reporting.run_reporting(spark, derived.log_events(spark, sf_dir), session_area(spark).path("out"))


def _saved_reports(spark, sf_dir):
    """Paths of one reporting run, which three queries read; kept until the program ends."""
    return _reports_of(spark.sparkContext.applicationId, sf_dir)


@_register
def saved_text_report(spark, sf_dir):
    """The lines of the saved text report, each with how often it occurs."""
    lines = spark.read.text(_saved_reports(spark, sf_dir)["final_report_txt"])
    counted = lines.where(~F.col("value").startswith("Generated: ")).groupBy(F.col("value").alias("line"))
    return counted.agg(F.count(F.lit(1)).alias("times"))


@_register
def saved_quality(spark, sf_dir):
    """The quality report as saved in JSON, its times as text."""
    schema = "total_records bigint, earliest_timestamp string, latest_timestamp string, quality_checks_passed bigint, quality_score double"
    return files.read_report(spark, _saved_reports(spark, sf_dir)["data_quality_report"], T.StructType.fromDDL(schema))


@_register
def saved_checks(spark, sf_dir):
    """The quality checks as saved in CSV."""
    return files.read_checks(spark, _saved_reports(spark, sf_dir)["data_quality_summary"])


@_register
def saved_analytics(spark, sf_dir):
    """The thirteen analytics results as saved in JSON, in one long table."""
    area = session_area(spark)
    events = derived.log_events(spark, sf_dir)
    shapes = analytics.all_analytics(events, analytics.rollup(events))
    paths = reporting.run_analytics(events, area.path("out"))
    saved = {}
    for name, shape in shapes.items():
        text = {"timestamp_ntz": T.StringType(), "decimal": T.DoubleType()}
        fields = [T.StructField(f.name, text.get(f.dataType.typeName(), f.dataType)) for f in shape.schema.fields]
        saved[name] = files.read_report(spark, paths[name], T.StructType(fields))
    return reporting.measures(saved)


@_register
def facet_filter(spark, sf_dir):
    events = derived.log_events(spark, sf_dir).select(*ANALYSIS_COLUMNS)
    return facets.facet_filter(events, service="orders", log_level="INFO", event_type="All", min_response_time=500)


@_register
def facet_values(spark, sf_dir):
    events = derived.log_events(spark, sf_dir)
    listed = [
        facets.facet_values(events, c).select(F.lit(c).alias("facet"), "position", "value")
        for c in ("service", "log_level", "event_type", "status")
    ]
    return functools.reduce(DataFrame.unionByName, listed)


@_register
def recent_logs(spark, sf_dir):
    return facets.recent_events(derived.log_events(spark, sf_dir), log_level="INFO")
