"""quarterloom - a PySpark-native engine for filing extraction and the quality of quarterly series."""
