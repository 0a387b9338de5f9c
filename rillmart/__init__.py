"""rillmart: a layered, real-time commerce mart written as Spark jobs.

Layers follow the data: ``sources`` read wire records, ``operators`` turn one
DataFrame into another, ``plans`` compose operators into the named jobs of the
warehouse, ``streaming`` holds the stateful Structured Streaming faces and
``sinks`` write results so that a replayed micro-batch changes nothing.
"""

__version__ = "0.1.0"
