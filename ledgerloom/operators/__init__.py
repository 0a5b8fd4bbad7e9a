"""Multi-step operators composed from built-in DataFrame operations."""
