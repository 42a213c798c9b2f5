"""Quillmill: document preparation, retrieval and evaluation as PySpark DataFrame transforms."""
