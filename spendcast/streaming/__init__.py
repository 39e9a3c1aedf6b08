"""Streaming: intentionally empty.

The original pipeline reads one static file of order lines and has no
streaming source, watermark, window or state, so nothing is built here.
The stateless operators (filters, month keys, code rules, lookups) are plain
DataFrame functions and apply unchanged to a ``spark.readStream`` source.
"""
