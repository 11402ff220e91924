"""A PySpark engine for length-of-stay analytics.

Functions that run inside Python workers are shipped by value, so executors
need no copy of the package and the driver may import it from any folder.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
