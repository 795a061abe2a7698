"""Table scans, sinks and the star schema they feed."""
