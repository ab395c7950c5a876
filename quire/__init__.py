"""quire: a Spark-first engine that compiles page and block text into typed nodes and datasets."""

__version__ = "0.1.0"
