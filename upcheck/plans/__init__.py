"""End-to-end plans: the upload job, its presets, fixtures and query catalog."""
