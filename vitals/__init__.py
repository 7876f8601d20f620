"""Health analytics for open-source ecosystems, built on Spark DataFrames.

Every product is a function from DataFrames to one lazy DataFrame. Nothing in
``operators`` runs an action; actions live in ``sources.writers``,
``plans.jobs`` and the tests.
"""
