"""Operators for training-data pipelines: text scoring, filtering, deduplication, mixing, archives.

Nothing else in the library imports this subpackage.  Functions that run on executors are
shipped by value, so executors need the third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
