"""An analytics engine for collections of documents, on Spark's DataFrame API."""
