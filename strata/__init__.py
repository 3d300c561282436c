"""strata: feature, retrieval, imaging-table and evaluation operators on PySpark.

Every operator takes and returns DataFrames and is meant for ``df.transform``.
"""

import sys as _sys

__version__ = "0.1.0"

# Functions run in Python workers (Arrow batch functions) are pickled by value, so the
# workers need no installed copy of this package (no ``--py-files`` step, any cwd).
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without by-value support
    pass
