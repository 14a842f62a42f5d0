"""End-to-end plans: prepare, pretokenize, train-data loading."""
