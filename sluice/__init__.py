"""sluice: dictionary-driven cleaning of wide, all-text tables on Spark."""

__version__ = "0.1.0"
