from holdfast.sources.files import load_cleaned, read_csv, read_csv_marked, write_parquet
from holdfast.sources.versions import Superseded, current_path, replacing

__all__ = ["Superseded", "current_path", "load_cleaned", "read_csv", "read_csv_marked", "replacing", "write_parquet"]
