"""Feature tables, classifiers and their evaluation."""
