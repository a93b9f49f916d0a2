"""DataFrame-to-DataFrame operators: flattening, merging and analyst questions."""
