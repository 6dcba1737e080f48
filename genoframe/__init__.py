"""Tables of variants, copy-ratio bins and intervals as Spark DataFrames.

``functions``  column functions and predicates; ``operators``  joins, windows,
aggregations, intervals and set operations over DataFrames; ``sources``  readers and
writers; ``plans``  whole analyses composed of these; ``llm``  an optional part for
text corpora.  Operators take column names, so they run on any table.
"""
