"""Split pruning and the resume manifest."""
