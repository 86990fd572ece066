"""Training-data operators for text tables; nothing else in the package depends on them."""
