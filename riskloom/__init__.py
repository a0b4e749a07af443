"""Spark-native operators for building, scoring and monitoring a binary risk model."""

__version__ = "0.1.0"
