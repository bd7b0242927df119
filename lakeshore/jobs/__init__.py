"""Daily jobs: each reads one partition, skips an empty one, transforms, checks, writes and counts."""
