"""Live updates of the tracking table."""
