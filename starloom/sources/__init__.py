from starloom.sources.convert import conform, convert
from starloom.sources.files import (
    file_count,
    preview,
    require_files,
    scan_csv,
    scan_json,
    scan_parquet,
)
from starloom.sources.staging import Staged, by_json_paths, read_json_paths, read_staged, stage

__all__ = [
    "Staged",
    "by_json_paths",
    "conform",
    "convert",
    "file_count",
    "preview",
    "read_json_paths",
    "read_staged",
    "require_files",
    "scan_csv",
    "scan_json",
    "scan_parquet",
    "stage",
]
