"""Intake: every input line is either usable or quarantined with a reason.

Text is parsed once. The tagged rows go to the shared scratch folder as
parquet, and everything after reads that.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions.timecols import parse_utc
from cadence.operators.quality import with_reason
from cadence.schema import CORRUPT_COLUMN, RAW, RAW_COLUMNS

QUARANTINE = T.StructType([*RAW.fields, T.StructField(CORRUPT_COLUMN, T.StringType()), T.StructField("reason", T.StringType())])


@dataclass(frozen=True)
class Intake:
    valid: DataFrame
    quarantined: DataFrame
    input_rows: int
    quarantined_rows: int

    @property
    def valid_rows(self) -> int:
        return self.input_rows - self.quarantined_rows


def split(
    raw: DataFrame, quarantine_null_keys: bool = False, outside: F.Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """All rows with ``reason`` and the columns of the quarantine table.

    Times are parsed once, into ``event_time_utc``, which ``outside`` may use: a
    condition for rows that do not belong to this input (a day folder that holds
    another date's rows). ``keep``: columns kept besides."""
    raw = raw.withColumn("event_time_utc", parse_utc("event_time"))
    tagged = with_reason(raw, quarantine_null_keys=quarantine_null_keys, parsed=F.col("event_time_utc"))
    if CORRUPT_COLUMN not in tagged.columns:
        tagged = tagged.withColumn(CORRUPT_COLUMN, F.lit(None).cast("string"))
    if outside is not None:
        tagged = tagged.withColumn("reason", F.coalesce("reason", F.when(outside, F.lit("outside the run date"))))
    return tagged.select(*QUARANTINE.fieldNames(), *keep)


def stage(spark: SparkSession, tagged: DataFrame, folder: str) -> Intake:
    """Write rows of :func:`split` once; the counts are observed in that job.
    Columns beyond the quarantine table's stay with the usable rows.

    One folder, no partitions: a partitioned write would sort every row."""
    seen = Observation("intake")
    counted = tagged.observe(seen, F.count(F.lit(1)).alias("rows"), F.count("reason").alias("bad"))
    counted.write.parquet(folder)
    rows = spark.read.schema(tagged.schema).parquet(folder)
    return Intake(
        rows.where("reason is null").drop(CORRUPT_COLUMN, "reason"),
        rows.where("reason is not null").select(*QUARANTINE.fieldNames()),
        seen.get["rows"],
        seen.get["bad"],
    )
