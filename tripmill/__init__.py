"""Monthly trip-record analytics as PySpark DataFrame jobs."""

from tripmill.contracts import PipelineParams

__all__ = ["PipelineParams"]
