"""tidecast: live-broadcast commerce analytics as Spark DataFrame operators."""
