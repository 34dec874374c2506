"""DataFrame transforms that work alike on batch and streaming input."""
