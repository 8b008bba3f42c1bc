"""Sequoir: a Spark-native engine for sequence catalogues and the table work around them."""
