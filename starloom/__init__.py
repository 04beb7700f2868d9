"""starloom: weave messy departmental files into a clean star schema on Apache Spark."""

__version__ = "0.1.0"
