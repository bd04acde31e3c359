"""Analytics over collections of excavation archives, as Spark jobs.

All archives live in one table set with an ``archive`` column.  Every operator
is a function from DataFrames to a DataFrame and covers all archives at once.
"""

import sys

from pyspark import cloudpickle

# Send helper functions along with the tasks, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
