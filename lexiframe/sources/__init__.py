"""Readers, writers and the shared scratch folder."""

from .dictionaries import last_entry_wins, read_categories, read_idf, read_stopwords
from .lines import number_lines, read_csv, read_lines, read_results
from .scratch import materialise, session_folder, shared_path
from .sinks import (
    pair_line,
    write_class_accuracy,
    write_lines,
    write_pairs,
    write_predictions,
    write_probabilities,
)

__all__ = [
    "last_entry_wins",
    "materialise",
    "number_lines",
    "pair_line",
    "read_categories",
    "read_csv",
    "read_idf",
    "read_lines",
    "read_results",
    "read_stopwords",
    "session_folder",
    "shared_path",
    "write_class_accuracy",
    "write_lines",
    "write_pairs",
    "write_predictions",
    "write_probabilities",
]
