"""DataFrame -> DataFrame operators. Their functions ship to executors by value, which need not have the package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
