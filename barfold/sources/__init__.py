"""Sources, staging and storage."""

from barfold.sources.market import (
    first_per_security,
    normalise_bars,
    read_bars,
    read_securities,
    select_bars,
    stack,
)
from barfold.sources.scratch import checkpoint_dir, materialise, release
from barfold.sources.staging import conform, iso_text, key_values, stage

__all__ = [
    "checkpoint_dir",
    "conform",
    "first_per_security",
    "iso_text",
    "key_values",
    "materialise",
    "normalise_bars",
    "read_bars",
    "read_securities",
    "release",
    "select_bars",
    "stack",
    "stage",
]
