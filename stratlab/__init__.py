"""stratlab: statistical profiling, stratification and regression studies as Spark jobs.

Every operator takes and returns DataFrames (or a handful of driver-side
scalars computed by one aggregate), so the work stays distributed and is
planned by Catalyst.
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions of this package that run on executors travel by value: no executor
# needs the package installed or on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
