"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Workers of a session that was started elsewhere may not find the package; its functions travel with the job.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
