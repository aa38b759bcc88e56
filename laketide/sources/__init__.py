"""Sources and sinks: JDBC and file landing, increments, storage zones, catalog."""
