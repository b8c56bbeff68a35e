"""stockflow: inventory analytics (ledger -> stock -> forecast -> reorder -> alerts -> reports)
expressed as Spark DataFrame functions.

Every operator is a pure function ``DataFrame(s) -> DataFrame``; time enters only through an
explicit ``as_of`` argument, never through the wall clock.
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]

import sys as _sys

try:  # executor-side functions (the admission fold, stream processors) travel with the task
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without by-value registration
    pass
