"""rowferry: move and shape records between systems with Spark.

A job is a source, a chain of transforms, a schema contract and a sink. Every
step is a function from DataFrame to DataFrame, so the same code serves batch
reads and Structured Streaming micro-batches.
"""
