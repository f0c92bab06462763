"""functions package."""
