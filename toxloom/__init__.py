"""Set-based Spark jobs that turn assay, chemical, bioactivity and wiki exports into a toxicology graph."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
