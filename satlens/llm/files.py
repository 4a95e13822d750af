"""Writing files of our own formats from tasks, into shared storage."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


@contextmanager
def committed(folder: str, name: str):
    """Opens ``folder/name`` for writing; the name appears only when the block ends well.

    A task that is run again (a lost executor, a speculative copy) writes the same
    bytes under the same name, so the last move wins and nothing is left twice.
    """
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    draft = f"{path}/_draft-{uuid.uuid4().hex}"  # readers skip names that begin with _
    with store.open_output_stream(draft) as out:
        yield out
    store.move(draft, f"{path}/{name}")
