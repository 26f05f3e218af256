"""Model plans: features, fit on training rows only, predict, report."""

from .forest_nodes import forest_nodes, walk_forest
from .house_prices import fit_house_prices, house_columns, predict_house_prices
from .linear_grid import (
    TunedLinear,
    combinations_of,
    part_moments,
    solve_linear,
    squared_error,
    tune_linear,
)
from .logistic_objective import feature_scales, logistic_objective, model_weights
from .model_reports import coefficients, forest_summary, loss_history, tuning_results
from .text_classification import (
    fit_text_forest,
    fit_text_logistic,
    text_counts_stages,
)
from .text_tuning import out_of_fold, tune_text_logistic
from .vector_classification import fit_component_logistic, project_components

__all__ = [
    "TunedLinear", "coefficients", "combinations_of", "feature_scales",
    "fit_component_logistic", "fit_house_prices", "fit_text_forest", "fit_text_logistic",
    "forest_nodes", "forest_summary", "house_columns", "logistic_objective", "loss_history",
    "model_weights", "out_of_fold", "part_moments", "predict_house_prices",
    "project_components", "solve_linear", "squared_error", "text_counts_stages",
    "tune_linear", "tune_text_logistic", "tuning_results", "walk_forest",
]
