"""Batch recommender analytics over explicit user-item ratings, on Spark.

Every operator is a function from DataFrame to DataFrame; none of them creates
or stops a session.  ``ratingloom.plans`` holds the spark-submit jobs.
"""
