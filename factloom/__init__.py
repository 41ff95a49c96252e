"""A PySpark-native engine that turns messy public records into a trustworthy dataset."""
