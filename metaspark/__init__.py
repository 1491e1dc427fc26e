"""Spark-native metadata intelligence: inventories, schemas, statistics, lineage.

Every job is a ``DataFrame -> DataFrame`` function; see the sub-packages:

* ``functions`` - Column expressions (names, paths, statuses, type lookups)
* ``sources``   - object listings, file footers, transaction logs, landed dumps
* ``operators`` - the relational work on those inputs
* ``plans``     - whole jobs: catalog entities per kind, union, sink
* ``streaming`` - the incremental catalog refresh
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: they need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
