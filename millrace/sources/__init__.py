from millrace.sources.files import list_files, preview_lines, read_csv
from millrace.sources.images import class_names, read_image_folder
from millrace.sources.tables import load_model, register, save_model, sql, table

__all__ = [
    "class_names",
    "list_files",
    "load_model",
    "preview_lines",
    "read_csv",
    "read_image_folder",
    "register",
    "save_model",
    "sql",
    "table",
]
