"""regiopanel: (region, year) indicator panels and their analysis on Spark."""

__version__ = "0.1.0"
