"""Bronze trees on the shared folder, written from the benchmark tables by Spark.

One folder per delivery year, one file in each: a header line, then the rows.  Headers and rows
carry the faults that the readers must cope with, by year and by key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import EXPOSURE_FEED_FIELDS, PAYMENT_FIELDS, PAYMENT_V2_FIELDS
from ..session import ensure_checkpoint_dir
from . import fixtures as fx


def _write(lines: DataFrame, header: Column, name: str) -> str:
    """Lines (year, value) as text files with ``header`` (an expression over year) first; the root folder."""
    root = f"{ensure_checkpoint_dir(lines.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    heads = lines.select("year").distinct().select("year", header.alias("value"), F.lit(0).alias("place"))
    rows = heads.unionByName(lines.select("year", "value", F.lit(1).alias("place")))
    rows.repartition("year").sortWithinPartitions("year", "place").select("year", "value").write.partitionBy("year").text(root)
    return root


def payment_headers(t: fx.Tables) -> str:
    """Payment files by year: header as agreed, with a byte-order mark, quoted, of version 2, columns
    swapped, a column short (by the year's remainder by 6)."""
    rows = fx.payments(t).select(F.year("payment_date").alias("year"), F.concat_ws(",", *[F.col(c).cast("string") for c in PAYMENT_FIELDS]).alias("value"))
    plain = ",".join(PAYMENT_FIELDS)
    forms = [plain, "\ufeff" + plain, ",".join(f'"{c}"' for c in PAYMENT_FIELDS), ",".join(PAYMENT_V2_FIELDS),
             ",".join([PAYMENT_FIELDS[1], PAYMENT_FIELDS[0], *PAYMENT_FIELDS[2:]]), ",".join(PAYMENT_FIELDS[:-1])]
    header = F.element_at(F.array(*map(F.lit, forms)), F.pmod("year", F.lit(len(forms))).cast("int") + 1)
    return _write(rows, header, "bronze-payments")


def exposure_files(t: fx.Tables) -> str:
    """Exposure files by year: rows two fields short (key % 7 = 1), one field long (% 7 = 2), with a
    quoted region that holds a comma (% 7 = 3) and with blank fields (% 7 = 4); marked headers."""
    k = F.pmod("o_orderkey", F.lit(7))
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in EXPOSURE_FEED_FIELDS}
    text["region"] = F.when(k == 3, F.concat(F.lit('"'), F.col("region"), F.lit(', WEST"'))).when(k == 4, F.lit("")).otherwise(F.col("region"))
    columns = [text[c] for c in EXPOSURE_FEED_FIELDS]
    line = F.when(k == 1, F.concat_ws(",", *columns[:-2])).when(k == 2, F.concat_ws(",", *columns, F.lit("more"))).otherwise(F.concat_ws(",", *columns))
    rows = fx.exposure_all(t).select(F.year("load_date").alias("year"), line.alias("value"))
    return _write(rows, F.concat(F.lit("\ufeff"), F.lit(",".join(EXPOSURE_FEED_FIELDS))), "bronze-exposure")
