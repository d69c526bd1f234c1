"""tidemark: a PySpark-native engine for turning semi-structured web records into clean datasets."""
