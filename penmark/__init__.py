"""penmark: decide who wrote a short text, as Spark DataFrame transformations.

``functions``  Column expressions (text cleaning, tokens, scores, names)
``sources``    readers and writers
``operators``  DataFrame -> DataFrame steps (curate, clean, encode, split, score, fit)
``streaming``  the same steps over Structured Streaming
``plans``      registered queries over the given tables, each with its SQL check
"""
