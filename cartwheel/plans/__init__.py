"""Composite plans: evaluation reports, model selection, the recommender facade and the query registry."""
