"""End-to-end plans and fixtures."""
