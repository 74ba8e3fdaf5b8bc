"""selfmend: Spark-native scoring of self-recovering network-problem tickets.

Layers (each a set of DataFrame -> DataFrame functions or Spark ML stages):

* ``sources``    delimited text scans, header handling, table contracts
* ``functions``  column-expression helpers (strict numerics, rule predicates)
* ``operators``  data quality, statistics, features, model, attach, sinks
* ``plans``      rule catalogues and the train / score flows built from them
* ``streaming``  the Structured Streaming job around ``plans.scoring.score``
"""

__version__ = "0.1.0"
