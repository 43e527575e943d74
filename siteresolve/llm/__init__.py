"""Operators for training-data pipelines. Nothing outside this subpackage imports it but the entry file, behind a guard."""
