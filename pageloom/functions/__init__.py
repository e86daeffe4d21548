"""Row-local column functions."""
