"""Daily metrics by date and place, as Spark DataFrame operators."""

from dayfold.schema import DEFAULT_SPEC, DIMENSION_SCHEMA, FACT_SCHEMA, PanelSpec

__all__ = ["DEFAULT_SPEC", "DIMENSION_SCHEMA", "FACT_SCHEMA", "PanelSpec"]
