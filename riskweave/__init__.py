"""Risk, fraud and document-retrieval analytics as Spark jobs.

Every operator takes DataFrames and returns DataFrames; column names are always
parameters. Sub-packages: ``sources`` (scans and sinks), ``functions`` (column
expressions), ``operators`` (tables in, tables out), ``plans`` (end-to-end
jobs) and ``streaming``.
"""

import sys

from pyspark import cloudpickle

# Task functions travel to the executors by value, so those need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
