"""Text operators for training-data pipelines: encoding, packing and reading level.

Nothing outside this subpackage imports it.
"""
