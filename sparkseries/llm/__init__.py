"""Operators of a training-data pipeline over text, pages and vectors; each module is one operator."""
