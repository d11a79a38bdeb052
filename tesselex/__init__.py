"""tesselex: document analytics and hybrid retrieval as lazy Spark plans."""

__version__ = "0.1.0"
