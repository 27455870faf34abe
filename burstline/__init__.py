"""Card-transaction stream analytics as plain ``DataFrame -> DataFrame`` transforms.

The same transforms run on batch tables and on Structured Streaming sources.
"""

__version__ = "0.1.0"
