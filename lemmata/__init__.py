"""lemmata: a PySpark-native analytics engine for document-extraction data."""
