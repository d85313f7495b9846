"""Parameterised SQL jobs and the registered queries over the shared test tables."""

from .registry import ORACLES, QUERIES  # noqa: F401


def load_all() -> None:
    """Import every query module so that it registers its queries."""
    from . import q_files, q_filesets, q_history, q_io, q_records, q_rules, q_steps  # noqa: F401
