"""Whole plans: the batch pipeline, publication, SQL views, the registered query keys."""
