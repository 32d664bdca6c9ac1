"""Streaming.

The analyses this library re-expresses are bounded batch jobs: no source is
read as a stream and no state is kept between runs, so there is no
streaming operator to provide.  The operators are plain DataFrame functions;
the stateless ones (filters, banding, tokenising, distances, point-in-zone
tests) accept a streaming DataFrame unchanged, and their aggregates run
under ``outputMode("complete")``.  See ``tests/test_streaming.py``.
"""
