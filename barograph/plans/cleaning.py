"""Raw files to the clean, partitioned observation table; and its split."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barograph.operators.decode import (
    PRECIPITATION_DEFAULT, decode_observations, decode_value_quality,
)
from barograph.operators.derive import (
    clean_numbers, derive_features, with_humidity, with_partition_keys,
)
from barograph.operators.quality import (
    TEMPERATURE_LIMITS, apply_median_fill, fit_median_fill, plausible_range, quality_filter,
    rejection_counts, standard_rules, tag_rejections,
)
from barograph.operators.split import hash_split
from barograph.sources.raw import read_raw
from barograph.sources.tables import (
    PARTITION_KEYS, cluster, read_table, replace_partitions, write_bounded, write_partitioned,
    write_table,
)

# Columns of the raw files the cleaning job reads.
RAW_COLUMNS = (
    "STATION", "DATE", "LATITUDE", "LONGITUDE", "ELEVATION", "NAME",
    "TMP", "DEW", "SLP", "VIS", "WND", "CIG",
)


@dataclass(frozen=True)
class CleaningReport:
    rows_in: int
    rows_kept: int
    rejected: dict[str, int]

    @property
    def rows_removed(self) -> int:
        return self.rows_in - self.rows_kept

    @property
    def retention_pct(self) -> float | None:
        return 100.0 * self.rows_kept / self.rows_in if self.rows_in else None


def decode_and_derive(
    raw: DataFrame, precipitation=PRECIPITATION_DEFAULT, exact_sentinel: bool = False
) -> DataFrame:
    return derive_features(decode_observations(raw, precipitation, exact_sentinel))


def clean_observations(
    raw: DataFrame, precipitation=PRECIPITATION_DEFAULT, exact_sentinel: bool = False
) -> DataFrame:
    """Clean observations from raw ones, lazily."""
    return quality_filter(decode_and_derive(raw, precipitation, exact_sentinel))


def run_cleaning(
    spark: SparkSession, input_path: str, output_path: str,
    precipitation=PRECIPITATION_DEFAULT, exact_sentinel: bool = False, fraction: float | None = None,
) -> CleaningReport:
    """Write the clean table partitioned by year and month; one scan of the input.

    The rule counts are observed in the writing stage itself, behind the
    shuffle: a task that reruns after an executor loss is counted once there,
    which does not hold for stages before a shuffle. The few rejected rows take
    part in the shuffle for that and are dropped right before the write.
    """
    raw = read_raw(spark, input_path, columns=[*RAW_COLUMNS, *precipitation])
    if fraction is not None:
        raw = raw.sample(fraction=fraction, seed=42)
    rules = standard_rules()
    tagged = tag_rejections(decode_and_derive(raw, precipitation, exact_sentinel), rules)
    counts = Observation("cleaning")
    kept = (
        cluster(tagged).observe(counts, *rejection_counts(rules))
        .where(F.col("rejected_by").isNull()).drop("rejected_by"))
    write_partitioned(kept, output_path, clustered=False)
    found = counts.get
    return CleaningReport(
        found["rows_in"], found["rows_kept"], {rule: found[rule] for rule in rules})


def run_split(
    spark: SparkSession, clean_path: str, output_path: str, keys=("STATION", "timestamp"),
    target: str = "temperature", partitioned: bool = True,
) -> dict[str, int]:
    """Write train and test below ``output_path``/split=...; rows per part.

    One scan and one write for both parts, counted in the writing stage.
    """
    labelled = read_table(spark, clean_path).where(F.col(target).isNotNull())
    table = hash_split(labelled, list(keys))
    layout = ("split", *PARTITION_KEYS) if partitioned else ("split",)
    counts = Observation("split")
    parts = ("train", "test")
    counted = cluster(table, layout).observe(
        counts, *[F.count_if(F.col("split") == part).alias(part) for part in parts])
    write_partitioned(counted, output_path, layout, clustered=False)
    return {part: counts.get[part] for part in parts}


def split_path(output_path: str, part: str) -> str:
    return f"{output_path.rstrip('/')}/split={part}"


def run_value_quality_etl(
    spark: SparkSession, input_path: str, output_path: str,
    scales: dict[str, float] | None = None, parts: dict[str, int] | None = None,
    columns: list[str] | None = None,
) -> None:
    """Value-quality files to a table partitioned by year and month.

    ``columns`` keeps only these raw columns; name them when the files have many
    different headers.
    """
    raw = read_raw(spark, input_path, malformed="drop", columns=columns)
    decoded = decode_value_quality(raw, scales, parts)
    if "DEW_num" in decoded.columns:
        decoded = with_humidity(decoded, "DEW_num", "label", "RH_num")
    write_partitioned(with_partition_keys(decoded), output_path)


# Columns of the value-quality table that get a median fill.
FILLED = ("WS_num", "DEW_num", "SLP_num", "VIS_num", "RH_num")


def run_value_quality_cleaning(
    spark: SparkSession, input_path: str, output_path: str, month_by_month: bool = False,
    files: int | None = None, medians: dict[str, float] | None = None,
    relative_error: float | None = 1e-3,
) -> dict[str, float]:
    """Labelled, plausible rows with filled numbers; returns the medians used.

    Pass ``medians`` fitted on training rows to avoid reading test rows.
    ``month_by_month`` replaces only the months in the input; ``files`` bounds
    the number of writing tasks.
    """
    labelled = with_partition_keys(
        read_table(spark, input_path).where(F.col("label").isNotNull()))
    columns = [name for name in FILLED if name in labelled.columns]
    numbers = clean_numbers(labelled, columns)
    if medians is None:
        medians = fit_median_fill(numbers, columns, relative_error)
    filled = apply_median_fill(numbers, medians).where(
        plausible_range("label", *TEMPERATURE_LIMITS, nullable=False))
    if month_by_month:
        replace_partitions(filled, output_path)
    elif files:
        write_bounded(filled, output_path, files, PARTITION_KEYS)
    else:
        write_partitioned(filled, output_path)
    return medians


def write_unpartitioned_split(table: DataFrame, train_path: str, test_path: str, keys) -> None:
    """Train and test as two unpartitioned data sets."""
    parts = hash_split(table, list(keys))
    for part, path in (("train", train_path), ("test", test_path)):
        write_table(parts.where(F.col("split") == part).drop("split"), path)
