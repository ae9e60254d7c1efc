"""Input schemas, readers, test-table views and writers."""
