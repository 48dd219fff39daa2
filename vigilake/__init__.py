"""Security-event analytics on PySpark: normalise, hunt, query, detect, triage."""

__version__ = "0.1.0"
