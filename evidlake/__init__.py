"""evidlake: evidence-grade batch analytics expressed as Spark DataFrame plans."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Executors need not have this package on their path: its functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
