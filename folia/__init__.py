"""folia: structure-aware document analytics as Spark DataFrame jobs."""
