"""Plan-shape helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluated_once(df: DataFrame) -> DataFrame:
    """Same rows and columns, with every column produced by a generator.

    Catalyst inlines projected expressions into the projections and filters
    above them.  When a rule list references a parsed value (a timestamp
    parse, a regex) many times, the inlined plan re-evaluates the parse per
    reference, and a filter on the rule result is rewritten into all of them.
    Columns that come out of ``inline`` are attributes the optimizer cannot
    inline through, so each value is computed once per row.  The partition
    key and the file name stay outside, so that filters on them still reach
    the scan."""
    kept = [c for c in ("load_date", "source_file") if c in df.columns]
    rest = F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in kept])))
    return df.select(*kept, rest).select(*[F.col(f"`{c}`") for c in df.columns])


#: Session setting: partitions that the readers deal a scan out to.  For inputs that arrive in
#: few splits (a gzip file, a Parquet file with one row group); unset: scans stay as they are.
INPUT_PARTITIONS = "spark.claimlake.inputPartitions"


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a raw scan over ``INPUT_PARTITIONS`` partitions, if the session sets that."""
    partitions = df.sparkSession.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(partitions)) if partitions else df
