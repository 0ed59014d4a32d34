"""Trending-video analytics on Spark: raw files to cleansed tables, quality gate and reports."""
