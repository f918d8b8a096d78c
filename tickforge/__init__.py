"""Spark-native trade-tick analytics: trades in, OHLCV bars, reports and checks out."""

import sys as _sys

__version__ = "0.1.0"

# Functions shipped to Python workers (mapInPandas bodies) are pickled by
# value, so executors run them without this package being installed or on
# their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: the package must then be shipped with --py-files
    pass
