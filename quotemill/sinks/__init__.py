"""Writers for files and published tables."""
