"""Operators for training-data pipelines: scans, joins, scoring, packing and archives over whole corpora."""
