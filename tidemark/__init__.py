"""Forecast-model operations as Spark DataFrame plans."""

from tidemark.contract import ModelSpec, PipelineSpec, TableContract

__all__ = ["ModelSpec", "PipelineSpec", "TableContract"]
