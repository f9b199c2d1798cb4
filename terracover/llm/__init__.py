"""Operators of a training-data pipeline; nothing else in the library imports them.

Their Python functions travel to the executors by value, so executors need the public
libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
