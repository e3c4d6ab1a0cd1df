"""claimlake — insurance lakehouse analytics expressed as Spark DataFrame jobs.

Layers: Bronze CSV feeds -> validated Silver partitions (+ quarantine) ->
cumulative Gold snapshots per valuation date -> report queries, plus a
Bornhuetter-Ferguson IBNR estimate by accident month.
"""

__version__ = "0.1.0"
