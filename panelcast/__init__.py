"""panelcast: daily panel time-series analytics on Spark.

A panel is a DataFrame with one row per (key, date) and a numeric target.
Every operator takes and returns a DataFrame; nothing is collected to the
driver except small, explicitly bounded results (metric rows, model
parameters).

Layout:
    sources/    readers, writers, fixture views derived from the test tables
    functions/  column expressions (safe division, guarded correlation,
                calendar encodings, size-checked broadcast)
    operators/  feature, profile, correlation, split, evaluation operators
    plans/      composed jobs: feature pipeline, forecasting jobs
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Grouped-map and mapInPandas functions of this package are shipped to the
# Python workers by value, so executors need no installed copy of it.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from panelcast.session import get_spark, checkpoint_dir  # noqa: E402

__all__ = ["get_spark", "checkpoint_dir"]
