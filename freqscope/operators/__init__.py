"""Relational operators: exact counts, sketch cells and readers, windows,
decay, membership, MinHash/LSH, accuracy metrics, hash quality."""
