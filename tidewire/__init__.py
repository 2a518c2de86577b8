"""PySpark-native processing of crawled documents: extract, clean, validate, score, deduplicate, analyse, alert."""
