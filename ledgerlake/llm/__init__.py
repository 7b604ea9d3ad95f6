"""Training-data operators.

Functions of this package travel to the executors by value, so a cluster
whose workers do not have the library installed can run them.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
