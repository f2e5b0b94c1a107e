"""Spark-native lakehouse for video-viewing events."""
