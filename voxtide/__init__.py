"""voxtide: voice-of-customer review processing as Spark DataFrame jobs."""

__version__ = "0.1.0"
