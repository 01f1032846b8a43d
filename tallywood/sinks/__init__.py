"""Writers for result tables and report texts."""
