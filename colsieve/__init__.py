"""colsieve: profile, reduce and evaluate wide numeric feature tables on Spark."""

import sys

from pyspark import cloudpickle

# Kernels ship to executors with their code, so workers need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
