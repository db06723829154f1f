"""Features for anomaly detection and the response-time profile they need."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logquarry.functions.numbering import numbered, place
from logquarry.functions.quantiles import quantiles_with
from logquarry.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from logquarry.session import Scratch

UNKNOWN = "UNKNOWN"
HIGH_RESPONSE_QUANTILE = 0.95


class Profile(NamedTuple):
    """Size of the table and the figures that features and rules need; None where no value exists."""

    total: int
    rt_median: float | None
    rt_p95: float | None
    status_median: float | None

    def literals(self) -> dict[str, Column]:
        return {name: F.lit(value).cast("double") for name, value in self._asdict().items() if name != "total"}


def profile(events: DataFrame) -> Profile:
    """Exact, linearly interpolated: both columns and the row count share their passes, none is gathered."""
    numbers = events.select("response_time_ms", "status")
    wanted = {"response_time_ms": [0.5, HIGH_RESPONSE_QUANTILE], "status": [0.5]}
    found, counts = quantiles_with(numbers, wanted, {"total": F.count(F.lit(1))})
    return Profile(counts["total"], *found["response_time_ms"], *found["status"])


def profile_row(found: Profile, spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([tuple(found)], "total bigint, rt_median double, rt_p95 double, status_median double")


def prepare_features(events: DataFrame) -> DataFrame:
    """Add time parts, indicators and filled categories. Numbers keep their nulls until imputation."""
    ts, level, event = F.col("timestamp"), F.col("log_level"), F.col("event_type")

    def part(value: Column) -> Column:
        return F.coalesce(value, F.lit(0)).cast("int")

    def flag(condition: Column) -> Column:
        return condition.cast("int")

    return events.withColumns(
        {
            "hour": part(F.hour(ts)),
            "day_of_week": part(F.weekday(ts)),
            "minute_of_hour": part(F.minute(ts)),
            "is_error": flag(level.eqNullSafe("ERROR")),
            "is_warning": flag(level.eqNullSafe("WARN")),
            "is_auth_failure": flag(event.eqNullSafe("AUTH_FAILURE")),
            "is_database_error": flag(event.eqNullSafe("DATABASE_ERROR")),
        }
    ).withColumns({c: F.coalesce(c, F.lit(UNKNOWN)) for c in CATEGORICAL_FEATURES})


def impute(features: DataFrame, medians: dict[str, Column]) -> list[Column]:
    """The nine numeric features as doubles, missing values replaced by the median.

    Only the response time and the status can be missing. A column without any value stays null, which
    takes it out of the model.
    """
    fill = {"response_time_ms": medians["rt_median"], "status": medians["status_median"]}
    return [
        (F.coalesce(F.col(c).cast("double"), fill[c]) if c in fill else F.col(c).cast("double")).alias(c)
        for c in NUMERIC_FEATURES
    ]


def model_inputs(events: DataFrame, medians: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """``id`` and the twelve model inputs: imputed numbers and filled categories.

    With ``keep`` those columns of the events instead, and the inputs as a struct ``inputs``. A number
    column with no values at all becomes constant, which no tree can split on.
    """
    features = prepare_features(events)
    numbers = [F.coalesce(c, F.lit(0.0)).alias(name) for name, c in zip(NUMERIC_FEATURES, impute(features, medians))]
    if keep is None:
        return features.select("id", *numbers, *CATEGORICAL_FEATURES)
    return features.select(*keep, F.struct(*numbers, *CATEGORICAL_FEATURES).alias("inputs"))


def category_positions(inputs: DataFrame, area: Scratch) -> DataFrame:
    """The one-hot position of every category value after the numbers: (category, value, position).

    Categories stand in their fixed order, values sorted within them. The distinct values are sorted by
    range and numbered by partition, so neither a task nor the driver holds a vocabulary.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("category"), F.col(c).alias("value")) for i, c in enumerate(CATEGORICAL_FEATURES)])
    values = inputs.select(F.inline(pairs)).distinct().repartitionByRange("category", "value").sortWithinPartitions("category", "value")
    stored = area.store(values.withColumn("place", place()), "category-values")
    return numbered(stored, "position", len(NUMERIC_FEATURES)).select("category", "value", "position")


def feature_vector(events: DataFrame, medians: dict[str, Column], area: Scratch) -> DataFrame:
    """``id``, ``numbers`` and ``ones``: the model inputs as a sparse vector.

    The nine numbers come first; ``ones`` are the positions that hold a 1, one for each category.
    """
    rows = model_inputs(events, medians)
    positions = category_positions(rows, area)
    for i, c in enumerate(CATEGORICAL_FEATURES):
        known = positions.where(F.col("category") == i).select(F.col("value").alias(c), F.col("position").alias(f"{c}_at"))
        rows = rows.join(known, c)
    return rows.select(
        "id", F.array(*NUMERIC_FEATURES).alias("numbers"), F.array(*[f"{c}_at" for c in CATEGORICAL_FEATURES]).alias("ones")
    )
