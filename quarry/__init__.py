"""quarry: PySpark jobs for common words, co-occurrence recommendation and Q&A clustering."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Ship this package's kernels to Python workers by value (no install needed on executors).
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
