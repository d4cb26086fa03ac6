"""Operators for training-data pipelines over ``documents``.

Nothing else in the library imports this subpackage. Its functions travel to the
workers by value, so the executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
