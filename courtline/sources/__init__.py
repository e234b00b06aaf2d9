"""Sources and sinks: named staging sources, landed extracts, table writers."""

from courtline.sources.landed import read_game_logs, read_list, read_team_year_totals
from courtline.sources.registry import Registry, Source
from courtline.sources.sinks import save_table, write_landed, write_table

__all__ = [
    "Registry",
    "Source",
    "read_game_logs",
    "read_list",
    "read_team_year_totals",
    "save_table",
    "write_landed",
    "write_table",
]
