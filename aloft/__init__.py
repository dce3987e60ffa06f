"""aloft: delay analytics on Spark.

Lazy DataFrame operators for event logs (entity, place, clock), timed site
observations and small dimension tables: cleaning, clock arithmetic,
composite-field decoding, predecessor lookup, lagged traffic rates,
nearest-site lookup, interval joins, grouped imputation, profiling,
feature building, MLlib classifiers and scoring.  No Python UDFs; every
operator is ``f(df, ...) -> DataFrame`` with column names as parameters.
"""

__version__ = "0.1.0"
