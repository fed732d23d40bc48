"""khayt: a Spark-native engine for text corpora and the entities named in them."""

__version__ = "0.1.0"
