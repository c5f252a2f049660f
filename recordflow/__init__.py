"""recordflow: a PySpark-native engine for repeatedly observed document collections."""
