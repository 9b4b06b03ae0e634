"""Short texts (and image captions) to one-sentence alerts, as Spark DataFrame operators."""

import sys as _sys

# Functions of this package that run in Python workers (Arrow UDFs, mapInPandas) are shipped by
# value, so executors need not have the package installed.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without by-value registration
    pass
