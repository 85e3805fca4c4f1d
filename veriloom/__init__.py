"""veriloom: verifier-in-the-loop document and run analytics on PySpark."""

__version__ = "0.1.0"
