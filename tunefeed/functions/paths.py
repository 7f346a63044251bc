"""Path strings of a run: per-user experiment name and checkpoint folder."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Root of user folders, and prefix of a checkpoint folder.
USER_ROOT = "/Workspace/Users"
CHECKPOINT_PREFIX = "/checkpoint-"


def user_path(name: Column, user: Column | None = None, root: str = USER_ROOT) -> Column:
    """``<root>/<user>/<name>``, by default for the session's user."""
    return F.concat_ws("/", F.lit(root), F.current_user() if user is None else user, name)


def checkpoint_path(output_dir: Column, step: Column) -> Column:
    """``<output_dir>/checkpoint-<step>``."""
    return F.concat(output_dir, F.lit(CHECKPOINT_PREFIX), step.cast("string"))
