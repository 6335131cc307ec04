"""logtide: log cleaning and event-time reporting as Spark DataFrame operators.

Batch tables and Structured Streaming micro-batches go through the same
functions, so a replay of a stream gives the same answer as the stream.
"""

__version__ = "0.1.0"
