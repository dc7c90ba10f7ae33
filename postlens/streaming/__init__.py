"""The stream classification job, its state and its readers."""
