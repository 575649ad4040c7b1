"""Inputs, outputs and stage tables."""

from .keyed import Keyed, write_keyed
from .ordered import Ordered, write_ordered
from .resume import ResumableStages
from .sizes import tasks_for
from .stages import Stages
from .tables import (
    Imported,
    import_curated,
    import_vocab,
    read_curated,
    read_observations,
    read_traits,
    read_vocab,
    scan_observations,
    scan_traits,
    write_list,
    write_traits,
    write_vocab,
)

__all__ = [
    "Imported",
    "Keyed",
    "Ordered",
    "ResumableStages",
    "Stages",
    "import_curated",
    "import_vocab",
    "read_curated",
    "read_observations",
    "read_traits",
    "read_vocab",
    "scan_observations",
    "scan_traits",
    "tasks_for",
    "write_keyed",
    "write_list",
    "write_ordered",
    "write_traits",
    "write_vocab",
]
