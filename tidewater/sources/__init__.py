"""Sources, sinks and the test views."""
