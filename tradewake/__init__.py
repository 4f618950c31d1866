"""tradewake: daily market-history analytics as Spark DataFrame functions.

Layers
------
``model``      column names, fixed defaults, and the views over the star-schema tables
``functions``  column expressions (spread, guarded correlation, error metrics, ...)
``sources``    compressed CSV, partitioned Parquet, the shared work folder
``operators``  DataFrame -> DataFrame building blocks
``plans``      whole jobs from path to path, and the registered queries
``streaming``  the cleaning rules over a stream of new daily files
"""

__version__ = "0.1.0"
