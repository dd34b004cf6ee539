"""berth: landing-zone analytics on Spark.

Every public function maps DataFrames (or Columns) to DataFrames (or Columns);
nothing is collected to the driver except a bounded catalogue and plan-time
size checks.
"""

__version__ = "0.1.0"

# Functions handed to grouped-pandas operators are shipped with the task
# (pickled by value), so executors need no copy of this package installed.
try:  # pragma: no cover - depends on the PySpark build
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
