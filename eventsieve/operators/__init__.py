"""Package module."""
