"""Operators for preparing large text corpora.

Nothing else in the library imports this package. Each module holds one operator; every
operator takes a DataFrame and the names of its columns. ``queries.py`` holds the registered
queries over the test tables, ``sql.py`` the check SQL of those that SQL can express.

Functions of this package are sent to the executors with the job, so these need not have it
installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
