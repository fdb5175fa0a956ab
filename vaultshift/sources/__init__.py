"""Sources and sinks: CSV scans and report files, and the fixture tables derived from test data."""
