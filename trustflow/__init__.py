"""Event-trust and journey-analytics jobs on Spark."""
