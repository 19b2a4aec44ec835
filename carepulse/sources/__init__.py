"""Sources and sinks: table scans, file datasets, fixtures and exports."""
