"""markforge: Spark-native preparation and post-processing of prompt -> markup corpora."""

import sys

__version__ = "0.1.0"

# Python operators (XML validity, pluggable token counters, generators) are
# shipped to Python workers by value, so executors need not have the package
# installed. Installing it on the cluster works as well.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass
