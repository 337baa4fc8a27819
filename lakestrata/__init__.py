"""lakestrata: medallion data operators and pipelines written for Spark.

Sub-packages
------------
``functions``   column expressions (text, time, masking, encryption)
``sources``     readers: tables, landed JSON feeds, logs, object inventory
``operators``   DataFrame -> DataFrame building blocks
``sinks``       layered writers, versioned star publishing, JDBC refresh
``plans``       consolidation, star schema, gold aggregates, full pipelines
``streaming``   Structured Streaming sales processor and activity alerts
``workload``    the registered queries and their SQL twins
"""

__version__ = "0.1.0"
