"""Operators for large text corpora that feed language models. Nothing outside this folder imports it."""
