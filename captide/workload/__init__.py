"""The queries registered for the driver, on documents derived from its tables."""
