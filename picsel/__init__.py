"""picsel: image-recommendation analytics for unillustrated wiki articles, on Spark.

Every operator is a pure function ``DataFrame(s) -> DataFrame`` that carries ``wiki_db`` as a key,
so one plan covers all wikis at once. Nothing is collected to the driver.
"""

__version__ = "0.1.0"
