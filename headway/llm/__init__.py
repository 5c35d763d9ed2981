"""Training-data operators: ten operators over documents and pages, and their queries.

Nothing outside this package imports it. Functions that run inside tasks are
shipped by value, so executors need not have the package installed.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
