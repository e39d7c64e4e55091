"""Batch analytics and recommendation jobs over game-catalogue snapshots, on PySpark."""
