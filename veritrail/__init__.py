"""Point-in-time entity risk analysis on Spark."""
