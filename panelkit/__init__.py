"""panelkit: daily-bar panel analytics (symbol x date) on Spark.

Every operator is a function ``DataFrame -> DataFrame`` or a ``Column``
builder.  A symbol is a partition key, never a separate frame: all symbols
run in one distributed job.
"""

import sys as _sys

try:  # ship grouped-map kernels by value: executors need not install panelkit
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

from panelkit.session import get_session, checkpoint_dir  # noqa: E402,F401
