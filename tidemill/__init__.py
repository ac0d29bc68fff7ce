"""Tidemill: a PySpark-native engine for curating chat, reasoning and reward corpora."""
