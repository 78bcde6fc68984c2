"""Operators for preparing training text: scoring, search, filters, deduplication, decontamination, encoding.

Every operator is a Spark job whose tasks handle bounded slices of rows with numpy; nothing here is imported by the
rest of the library. Functions of this package are shipped to executors by value, so these need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
