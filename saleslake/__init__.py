"""saleslake: weekly store sales, from dirty feed to star schema to answers, on Spark."""

__version__ = "0.1.0"
