"""cartwheel: recommendation analytics on purchase data, expressed as Spark DataFrame plans.

Sub-packages
------------
sources    -- loading interactions, CSV tables, list datasets, chunked CSV export
functions  -- column-level building blocks (ranking, hashing, weighting, metrics, prefix sums)
operators  -- recommenders, candidate generators, filters, features, rankers
plans      -- evaluation reports, model selection, the recommender facade, the query registry
llm        -- operators for preparing training text (nothing else imports it)
"""

__version__ = "0.1.0"
