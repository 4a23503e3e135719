"""On-time-performance analytics as plain Spark DataFrame functions.

``functions``  column expressions (times, buckets, text, observation decoding)
``operators``  DataFrame -> DataFrame building blocks that take column names
``sources``    readers, sinks, declared schemas, literal dimensions
``plans``      the enrichment job, the named analyses, features and models
``streaming``  the same transforms on Structured Streaming sources
"""
