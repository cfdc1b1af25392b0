"""flowlens: Spark-native analytics for captured network packets.

Decode packet records, enrich them with protocol, address class, location and
reputation, and score them with K-Means distance and an isolation forest, in
batch or Structured Streaming.  See README.md for the layout and
``python -m flowlens --help`` for the command line.
"""

__version__ = "0.1.0"
