"""Signal-archive analytics on Spark: functions from DataFrame to DataFrame."""

import sys

from pyspark import cloudpickle

# Python helpers of this package travel to the executors inside the tasks, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
