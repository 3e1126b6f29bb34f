"""Process-quality analytics on Spark: clean sensors, align them with a lagging
quality measurement, then correlate, fit, search, explain and rank."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
