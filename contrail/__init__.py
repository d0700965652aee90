"""contrail — air-traffic snapshot analytics expressed as Spark DataFrame plans.

Sub-packages:

* ``functions``  column expressions (route length, run columns, sentinel cleaning)
* ``operators``  DataFrame -> DataFrame building blocks (cleaning, ranking, spatial, bridge)
* ``sources``    readers / writers for landed snapshots and the Bronze/Silver/Gold layers
* ``plans``      the indicators, the batch run and the query registry
* ``streaming``  Structured Streaming ingestion and de-duplication
"""

__version__ = "0.1.0"
