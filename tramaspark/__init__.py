"""A Spark-native engine for building and analysing knowledge graphs of people, places and events."""
