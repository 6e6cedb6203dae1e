"""pairloom: build and judge paired-text corpora with Spark DataFrames.

Layout
------
functions/  Column -> Column expressions (text, measures, markup)
operators/  DataFrame -> DataFrame operators (spans, pairs, negatives,
            corpus, tf-idf, evaluation, agreement, skew-safe ranking)
sources/    table readers, test-data adapters, file sources and sinks
plans/      composite pipelines that chain operators end to end
streaming/  incremental (Structured Streaming) variants
"""

__all__ = ["session"]
