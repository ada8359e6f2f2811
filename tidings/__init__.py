"""tidings — news event analytics on Spark."""

# Ship this package's code with every pandas UDF closure, so Python workers
# need not have the repository on their path (cluster or local).
try:  # pragma: no cover - depends on the installed pyspark
    import sys as _sys

    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
