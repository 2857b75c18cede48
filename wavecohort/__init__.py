"""wavecohort: longitudinal cohort analytics on Spark.

Functions of this package that run in Python workers (the mixed-model
passes, p-value helpers) are pickled by value, so executors need not have
the package installed or on their path.
"""

import sys as _sys

try:  # pragma: no cover - depends on the PySpark build
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
