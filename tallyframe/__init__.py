"""Decision-support reports, table layout, run-log analytics, user-function apply and learning stages on PySpark."""

import sys

from pyspark import cloudpickle

# User functions travel to the executors by value, so that these need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
