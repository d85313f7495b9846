"""Writers for logs, history slices, exports and record files."""
