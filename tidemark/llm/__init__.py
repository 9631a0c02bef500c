"""Operators for preparing training data at scale. Nothing else in the library imports these.

Functions of this package that run inside tasks travel with the tasks, so that executors do
not need the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
