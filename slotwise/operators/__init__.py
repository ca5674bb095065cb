"""DataFrame operators of the targeting pipeline."""
