"""Column-level building blocks: ranking, hashing, weighting, metrics and distributed prefix sums."""
