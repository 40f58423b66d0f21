"""Table scans, sinks, corpus readers, row accounting and the run log."""
