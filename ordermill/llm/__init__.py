"""Training-data operators: text statistics, models and filters over whole corpora.

Nothing outside this package imports it.
"""
