"""goldleaf — medallion (bronze → silver → gold) payments toolkit on PySpark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
built-in Spark SQL expressions; pipelines compose them with
``DataFrame.transform``; only ``goldleaf.sources`` touches storage.
"""

__version__ = "0.1.0"
