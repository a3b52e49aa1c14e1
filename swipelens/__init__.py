"""Point-in-time features, training and evaluation for card transactions on Spark."""

__version__ = "0.1.0"
