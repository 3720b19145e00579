"""Joins, aggregations and sorts; DataFrame in, DataFrame out."""
