"""File paths as Spark gives them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def below(path: Column, folder: str) -> Column:
    """Part of a file path below a folder. File paths are percent-encoded; the folder is cut off where it
    first occurs, as its name may be repeated further down."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    root = "/" + folder.removeprefix("file:").lstrip("/") if folder.startswith(("file:", "/")) else folder
    return F.substring(plain, F.instr(plain, root) + len(root), F.length(plain))
