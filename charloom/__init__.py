"""charloom: character n-gram language-model analytics on Spark DataFrames."""

from charloom.plans.model import CharModel, ModelParams  # noqa: F401

__all__ = ["CharModel", "ModelParams"]
