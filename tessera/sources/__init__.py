from tessera.sources.files import (read_csv_multi_encoding, pick_csv_in_folder, standardize_columns,
                                   nan_to_null, write_layer, read_layer, layer_exists, latest_layer,
                                   export_filtered_csv, write_config, read_config, stats_report_table, markdown)

__all__ = ["read_csv_multi_encoding", "pick_csv_in_folder", "standardize_columns", "nan_to_null",
           "write_layer", "read_layer", "layer_exists", "latest_layer", "export_filtered_csv",
           "write_config", "read_config", "stats_report_table", "markdown"]
