"""The model chain as lazily built ``DataFrame``s.

raw → clean → staging → (dimension) → fact → carrier report, trend report.
Each attribute is built on first use from the previous ones, so a caller
that needs only the fact never plans the reports. Nothing here runs an
action; Catalyst sees one plan from the scan to whatever is asked for.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession

from tarmac.operators import clean as clean_ops
from tarmac.operators import marts, staging
from tarmac.sources.fixtures import load_flights_raw


@dataclass
class Models:
    raw: DataFrame
    as_of: _dt.date | str | Column | None = None
    dedupe_keys: bool = False

    @property
    def spark(self) -> SparkSession:
        return self.raw.sparkSession

    @cached_property
    def clean(self) -> DataFrame:
        return clean_ops.clean(self.raw)

    @cached_property
    def staging(self) -> DataFrame:
        return staging.stage(self.clean, self.as_of, dedupe_keys=self.dedupe_keys)

    @cached_property
    def dim(self) -> DataFrame:
        return marts.carrier_dimension(self.spark)

    @cached_property
    def fact(self) -> DataFrame:
        return marts.build_fact(self.staging)

    @cached_property
    def carrier_report(self) -> DataFrame:
        return marts.delay_by_carrier(self.fact)

    @cached_property
    def trend_report(self) -> DataFrame:
        return marts.delay_trend(self.fact)


def from_test_data(spark: SparkSession, sf_dir: str, **kwargs) -> Models:
    """Model chain over the flights-shaped rows of a test-data directory."""
    return Models(load_flights_raw(spark, sf_dir), **kwargs)
