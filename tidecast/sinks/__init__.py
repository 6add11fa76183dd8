"""Writers for batch and micro-batch results."""
