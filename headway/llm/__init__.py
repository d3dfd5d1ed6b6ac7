"""Training-data operators: sharding, joins, filters, extraction, scoring and mixing.

Task-side helpers are shipped to executors by value, so a cluster needs no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
