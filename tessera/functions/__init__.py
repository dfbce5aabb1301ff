from tessera.functions.safe import (nan_to_null, sample_skew, safe_corr, sql_std_name,
                                    numeric_columns, string_columns)
from tessera.functions.names import standardize_name, standardize_names
from tessera.functions.quantile import exact_quantiles, quantile_row, mode_table

__all__ = ["nan_to_null", "sample_skew", "safe_corr", "sql_std_name", "numeric_columns",
           "string_columns", "standardize_name", "standardize_names", "exact_quantiles",
           "quantile_row", "mode_table"]
