"""Timed-text analytics on Spark: segmentation, repair, search, audit and incremental reprocessing."""
