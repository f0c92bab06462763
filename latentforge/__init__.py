"""latentforge — image/caption preparation and diffusion-data operators on Spark.

Every operator takes DataFrames and returns DataFrames; nothing is computed
until an action runs.  Modules:

* ``sources``   — tables, stand-in views, annotation/image readers, sinks
* ``functions`` — column expressions (text, durations, randomness, arrays)
* ``operators`` — filters, aggregates, joins, windows, sampling, positions,
  batching, image, diffusion, inference, set operations
* ``plans``     — the end-to-end jobs (curation, embedding, training input,
  sampling, scaling study)
* ``streaming`` — the encode queue as a Structured Streaming query
"""

__version__ = "0.1.0"
