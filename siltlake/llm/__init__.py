"""Operators for preparing training data at scale, one module each.

Nothing else in the library imports this subpackage. Its functions run inside
Spark tasks and are pickled by value, so workers need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
