"""Reading drifting feeds and writing, appending and publishing tables."""
