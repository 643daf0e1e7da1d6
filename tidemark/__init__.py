"""tidemark: measurement stream analytics on Spark (batch and Structured Streaming).

Packages: ``sources`` (tables, record views, stream sources), ``functions``
(column expressions), ``operators`` (DataFrame -> DataFrame transforms),
``plans`` (pipelines, registered queries, oracles), ``streaming`` (stream
queries and sinks); ``jobs`` is the command-line entry point.
"""

__version__ = "0.1.0"
