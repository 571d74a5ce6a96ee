"""Finance, lease and site-utilisation analytics as Spark jobs.

The package is organised the way a batch job reads: ``sources`` produce
DataFrames, ``operators`` turn DataFrames into DataFrames, ``plans`` compose
operators into whole jobs and ``streaming`` holds the incremental ingestion.
``functions`` are plain column expressions.  Nothing here runs an action unless
its docstring says so.
"""

__version__ = "0.1.0"
