"""Panel, cross-section, statement and export operators: functions from DataFrame to DataFrame."""
