"""Spark-native curation of large registries: relational, spatial, text, linkage, hierarchy and change-log operators."""
