"""lift: supervised feature work on entity tables, as Spark jobs.

``sources``    keyed tables, SQL access, score sinks
``functions``  column expressions shared by the operators
``operators``  registry, assembly, profiling, encoding, splits, models, metrics
``plans``      load, select, build and score from end to end
"""
