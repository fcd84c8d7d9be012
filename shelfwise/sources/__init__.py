from shelfwise.sources.tables import load_driver_tables, load_library, read_table, save_library
from shelfwise.sources.layout import write_layout
from shelfwise.sources.append import append_from, append_rows, apply_defaults, assign_ids

__all__ = ["load_driver_tables", "load_library", "read_table", "save_library", "write_layout",
           "append_from", "append_rows", "apply_defaults", "assign_ids"]
