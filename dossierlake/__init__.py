"""Spark-native engine for collections of structured reports: every stage takes DataFrames and returns DataFrames."""
