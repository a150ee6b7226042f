"""Training-data operators: text, URL and vector jobs of a large corpus pipeline.

Nothing else in the library imports this subpackage.
"""
