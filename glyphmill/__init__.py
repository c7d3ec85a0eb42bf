"""Structure free text at scale: sentiment, entities, quality checks, drift and
versioned tables, expressed as Spark DataFrame transformations."""

__version__ = "0.1.0"
