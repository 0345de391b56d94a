"""Raster-stack analytics as Spark DataFrame jobs."""
