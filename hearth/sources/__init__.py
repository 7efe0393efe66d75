"""Sources, sinks and driver-table bindings."""
