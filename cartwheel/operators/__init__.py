"""Recommenders, candidate generators, filters, features and rankers (DataFrame in, DataFrame out)."""
