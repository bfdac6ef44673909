"""Latent semantic analysis and sensor outlier detection as Spark jobs.

Every operator takes and returns DataFrames.  The caller owns the session.
"""
