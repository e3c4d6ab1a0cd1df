"""Generation numbers that no two publishers share.

A publisher claims its number before it reads its inputs, by creating a marker file that must
not exist yet; whoever loses the race takes the next number.  Readers follow the highest
number that was committed, so a publisher that started earlier and finishes later never
replaces newer rows, whatever the clocks of the drivers say.  A claim without a commit (a
publisher that died) leaves a gap that readers pass over.

``createNewFile`` is exclusive on HDFS and on stores with conditional writes; on others two
publishers of one date need a lock of the store's own.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _folder(spark: SparkSession, place: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def claimed(spark: SparkSession, root: str) -> list[int]:
    """The numbers claimed under ``root``, ascending (one small file each)."""
    fs, folder = _folder(spark, f"{root.rstrip('/')}/_claims")
    if not fs.exists(folder):
        return []
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(folder) if f.getPath().getName().isdigit())


def claim(spark: SparkSession, root: str) -> int:
    """The next free number under ``root``, now taken."""
    number = max(claimed(spark, root), default=0) + 1
    while True:
        fs, marker = _folder(spark, f"{root.rstrip('/')}/_claims/{number:08d}")
        fs.mkdirs(marker.getParent())
        if fs.createNewFile(marker):
            return number
        number += 1
