"""voxseries: what a crowd says about named groups, as a time series beside an external one.

Everything is a DataFrame in, DataFrame out function; nothing here runs a job by itself
except the writers, model training and the size check of a word list.
"""

import sys

from pyspark import cloudpickle

from voxseries.session import get_session

# Python functions of this package travel to the executors with the plan, so it need not be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_session"]
