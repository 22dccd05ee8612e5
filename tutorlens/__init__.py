"""tutorlens: learning-analytics feature engineering as Spark DataFrame plans.

Everything is a function ``DataFrame -> DataFrame`` (usable with ``df.transform``)
built from native Spark expressions, so Catalyst prunes columns, pushes filters
into the scan and plans the shuffles.  Sub-packages:

* ``sources``    table schemas, CSV/Parquet loading with pandas-style missing
                 values, sinks, and the learning-shaped fixture views.
* ``functions``  small column helpers (null rules, lookups, rounding).
* ``operators``  cleaning, features, profiling, distributions, encoding, split.
* ``plans``      the end-to-end pipelines and the registered queries.
* ``streaming``  incremental engagement features over an appended click log.
"""

from tutorlens.keys import K2, K3

__all__ = ["K2", "K3"]
