"""Operators on tables of blocks, chunks and documents: DataFrame in, DataFrame out."""
