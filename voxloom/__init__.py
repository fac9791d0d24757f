"""Segment analytics on Spark: interval, sequence and similarity operators as DataFrame-to-DataFrame functions."""
