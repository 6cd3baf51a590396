"""Every registered query with its oracle; importing the modules fills the registry."""

from larkspur.catalog import (  # noqa: F401
    aggregate_queries, closed_form_queries, column_queries, evaluation_queries, feature_queries, model_queries, quality_queries, series_queries, source_queries, text_queries,
)
from larkspur.catalog.registry import ENTRIES  # noqa: F401
