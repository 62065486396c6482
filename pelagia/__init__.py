"""Pelagia: a Spark-native engine for gridded climate and ocean cell tables."""
