"""Column functions. Only document parsing runs in Python, in Arrow batches."""
