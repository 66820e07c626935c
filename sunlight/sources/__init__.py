from sunlight.sources.dims import (dim_dept_region, dim_region, dim_speciality,
                                   DEPT_TO_REGION, REGIONS, SPECIALITIES)
from sunlight.sources.files import (read_text_csv, read_csv_union, read_csv_union_by_name,
                                    CsvRead, read_tolerant_tsv, first_lines,
                                    read_headerless_tsv, read_geo_points, read_tables,
                                    lower_columns, list_files, PANDAS_NA_VALUES, spread,
                                    register_views)

__all__ = [
    "dim_dept_region", "dim_region", "dim_speciality", "DEPT_TO_REGION",
    "REGIONS", "SPECIALITIES", "read_text_csv", "read_csv_union", "read_csv_union_by_name", "CsvRead", "first_lines",
    "read_tolerant_tsv", "read_headerless_tsv", "read_geo_points", "read_tables",
    "lower_columns", "list_files", "PANDAS_NA_VALUES", "spread", "register_views",
]
