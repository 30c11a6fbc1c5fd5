"""corpusprep: Spark-native preparation of language-model training corpora.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from
DataFrame/SQL expressions; Arrow-batched pandas UDFs are used only where
built-in expressions cannot state the semantics efficiently.
"""

import sys as _sys

__version__ = "0.1.0"

# Ship UDF code by value: executors need not have this package installed
# (on a cluster it can still be distributed with --py-files).
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass
