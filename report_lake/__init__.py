"""report_lake: positional daily reports -> queryable tables, on Spark.

Functions handed to Python workers (``mapInPandas`` for archive expansion,
fetching and file writing) are pickled by value, so executors need no copy of
this package installed.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__all__ = ["spec", "session"]
