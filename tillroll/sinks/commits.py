"""Commit records: what the outputs of a job consist of, after each run.

``<root>/commits/<version>.json`` is a small text that names the folders of every
output. A run writes its folders first and then the next version, which is what
makes them count; readers resolve every output by the newest version, so they see
all of a run or nothing of it. A version is created, never replaced: of two
writers that started from the same version one fails, and a run id is committed
once. (The store decides who creates a file first; on one that lets two writers
create the same name, only one job may write at a time.) A text that was cut off
while it was written counts as nothing.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import SparkSession

from tillroll.sources import fs


class CommitConflict(RuntimeError):
    """Another writer committed since this one started."""


class AlreadyCommitted(RuntimeError):
    """The run id has a commit; a new run needs a new one."""


@dataclass(frozen=True)
class State:
    """Folders are named below the root. Sizes: a line a run, a line a month of each output."""

    #: Of the newest run that counts; None before the first.
    run_id: str | None = None
    #: Run -> output -> the folder that the run wrote.
    runs: dict[str, dict[str, str]] = field(default_factory=dict)
    #: Output -> month folder -> the folders that hold the month now.
    months: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    #: Output -> schema (JSON) of its files.
    schemas: dict[str, str] = field(default_factory=dict)
    #: Tables of the files that are done with, oldest first.
    done: list[str] = field(default_factory=list)
    #: Tables of the keys of files whose rows no longer count.
    retracted: list[str] = field(default_factory=list)
    #: Run folder of a partitioned mart -> the keys that are folders in it.
    folder_keys: dict[str, list[str]] = field(default_factory=dict)
    #: Highest version there was when this was loaded.
    seen: int = 0


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/commits"


def versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n.split(".")[0]) for n in fs.glob_names(spark, _folder(root), "*.json"))


def load(spark: SparkSession, root: str) -> State:
    """The newest committed state; an empty one where nothing is committed."""
    found = versions(spark, root)
    for v in reversed(found):
        try:
            state = State(**json.loads(fs.read_text(spark, f"{_folder(root)}/{v:012d}.json")))
        except ValueError:  # cut off
            continue
        return replace(state, seen=found[-1])
    return State(seen=found[-1] if found else 0)


def commit(spark: SparkSession, root: str, state: State) -> State:
    """Make ``state``, built from one that was loaded, the newest. CommitConflict if another came first."""
    found = versions(spark, root)
    if (found[-1] if found else 0) != state.seen:
        raise CommitConflict(f"{root} has version {found[-1]} by now, this writer started from {state.seen}")
    new = replace(state, seen=state.seen + 1)
    try:
        fs.create_text(spark, f"{_folder(root)}/{new.seen:012d}.json", json.dumps(asdict(new), indent=1, sort_keys=True))
    except FileExistsError as e:
        raise CommitConflict(f"{root}: version {new.seen} was created by another writer") from e
    return new
