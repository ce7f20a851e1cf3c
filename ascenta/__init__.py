"""ascenta: a PySpark-native engine that derives a catalogue of road climbs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Kernels that run inside executors travel with the job instead of being
# imported there, so the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
