"""Analytics over collections of web pages, as Spark jobs."""
