"""loyalspan: customer lifetime value as Spark jobs.

``sources``    readers, writers and the small tables around a run
``functions``  column expressions: dates, special functions, purchase and spend models
``operators``  DataFrame-to-DataFrame building blocks: roll-ups, ranking, metrics, fitting
``plans``      whole jobs: prepare snapshots, train and evaluate models, score customers
"""
