"""Column expressions: casts, recodes, labels, row hashes, names."""

from cohortlens.functions.casts import lenient
from cohortlens.functions.codes import additive_score, binary_flag, code_label
from cohortlens.functions.hashing import Hasher, bucket_of, fast_row_hash, row_hash
from cohortlens.functions.names import LEADING_YEAR, PART_YEAR, year_from_name

__all__ = [
    "LEADING_YEAR",
    "PART_YEAR",
    "Hasher",
    "additive_score",
    "binary_flag",
    "bucket_of",
    "code_label",
    "fast_row_hash",
    "lenient",
    "row_hash",
    "year_from_name",
]
