"""feedlens: product analytics for a feed + messenger app, built on Spark.

Every job is a function from DataFrames (plus keyword parameters such as
``as_of``) to a DataFrame.  Nothing is collected to the driver inside the
library; the caller decides when to act.

Subpackages
-----------
sources    schemas, readers, test fixtures, the slices sink
functions  column-level helpers: day filters, Welch t-test, p-values, hashing
operators  building blocks: per-day metrics, per-user totals, slices,
           experiments, cohorts
plans      composite reports and the query catalogue used by the checks
streaming  live window metrics on event streams
"""

__all__ = ["session"]
