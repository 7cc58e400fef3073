"""Event-time analytics on market ticks, written against the Spark DataFrame API."""
