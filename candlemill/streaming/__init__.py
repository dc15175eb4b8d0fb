"""The bar operator over a stream."""
