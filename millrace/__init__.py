"""millrace: table preparation and model evaluation as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions sent to tasks carry their code along, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
