"""Analytics over document corpora as Spark DataFrame transformations."""
