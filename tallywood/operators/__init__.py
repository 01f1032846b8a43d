"""Analytics over log lines (``value, file_path``) and trip records."""
