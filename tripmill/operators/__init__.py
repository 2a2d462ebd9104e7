"""Relational steps of the pipeline: DataFrame in, DataFrame out."""
