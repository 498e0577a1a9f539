"""Named datasets, readers and writers."""
