"""Part of kiln."""
