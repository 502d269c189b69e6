"""tierflow: layered (bronze, silver, gold) batch analytics as PySpark DataFrame operators."""

__version__ = "0.1.0"
