"""Operators for training-data pipelines: text, vectors and dialogues at corpus scale."""
