"""gaugelake: a gauge-reading archive and its monitoring queries as Spark jobs."""

__version__ = "0.1.0"
