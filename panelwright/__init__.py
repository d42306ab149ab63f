"""Spark-native analytics over panels of count time-series.

Every operator is a function from DataFrame to DataFrame.  Nothing is evaluated until the caller
acts on the result, except where a docstring says that an operator checkpoints.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The functions of the few Python jobs travel inside the task, so that executors need no
# installation of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
