"""Brand-visibility evidence analytics as Spark DataFrame operators."""

from sightline.session import get_spark

__all__ = ["get_spark"]
