"""Product catalogues on Spark: ingest, harmonise, score and rank."""

import sys

from pyspark import cloudpickle

# Send the few functions that run on executors along with the job, so the
# package has to be installed on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
