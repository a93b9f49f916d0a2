"""Table specs and the daily bronze-to-silver plan."""
