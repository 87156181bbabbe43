"""Streaming text and indicator analytics on Spark.

Operators are lazy ``DataFrame -> DataFrame`` functions built from Spark's own expressions; the
packages are ``functions`` (column expressions), ``operators`` (batch and stream transforms),
``sources`` (readers and writers), ``streaming`` (queries and sinks) and ``plans`` (whole jobs).
"""
