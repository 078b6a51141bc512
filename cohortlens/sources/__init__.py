"""Scans of raw survey files, landed parts and the cleaned table."""

from cohortlens.sources.headers import FileLayout, header_groups
from cohortlens.sources.staging import shared_folder, staged, unstage
from cohortlens.sources.survey import (
    POSITION_COLUMNS,
    ROW_KEY,
    YEARLY_GLOB,
    read_cleaned,
    read_parts,
    read_survey,
    read_yearly,
    with_file_year,
)

__all__ = [
    "POSITION_COLUMNS",
    "ROW_KEY",
    "YEARLY_GLOB",
    "FileLayout",
    "header_groups",
    "read_cleaned",
    "read_parts",
    "read_survey",
    "read_yearly",
    "shared_folder",
    "staged",
    "unstage",
    "with_file_year",
]
