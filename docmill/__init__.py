"""docmill: documents to a retrieval store, as DataFrame plans on Spark."""

__version__ = "0.1.0"
