"""Operators for training data.

What tasks run of this package travels with the task, so that executors need no
copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
