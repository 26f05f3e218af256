"""Operators: DataFrame in, DataFrame out."""

from .attaching import attach_by_position, attach_features, attach_lookup
from .cleaning import cast_label, fill_numbers, fill_text, keep_below
from .components import Components, principal_components, project
from .covariance import covariance_matrix
from .encoding import CategoryIndex, category_index, one_hot_positions, vector_positions
from .metrics import (
    area_under_roc,
    confusion_matrix,
    per_label_metrics,
    rmse,
    test_error,
    weighted_metrics,
)
from .positions import with_earlier_totals, with_position
from .profiling import (
    class_balance,
    drop_columns_missing_in,
    missing_profile,
    preview,
    schema_report,
    value_counts_per_column,
)
from .selection import best_features, chi_squared
from .splitting import fold_by_key, random_split, sample_by_key, split_by_key
from .terms import document_frequency, term_frequency, tf_idf
from .vector_categories import few_values, fit_vector_indexer

__all__ = [
    "CategoryIndex", "Components", "area_under_roc", "attach_by_position", "attach_features", "attach_lookup", "cast_label",
    "best_features", "category_index", "chi_squared", "class_balance", "confusion_matrix", "covariance_matrix",
    "document_frequency", "drop_columns_missing_in", "fill_numbers", "fill_text",
    "few_values", "fit_vector_indexer", "fold_by_key", "keep_below", "missing_profile", "one_hot_positions",
    "per_label_metrics", "preview", "principal_components", "project", "random_split", "rmse", "sample_by_key",
    "schema_report", "split_by_key", "term_frequency", "test_error", "tf_idf",
    "value_counts_per_column", "vector_positions", "weighted_metrics",
    "with_earlier_totals", "with_position",
]
