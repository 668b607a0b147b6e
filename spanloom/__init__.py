"""Spark-native evidence analytics: papers, spans, claims, entities and question/answer pairs as DataFrames."""
