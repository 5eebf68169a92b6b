"""Files of our own formats in the shared folder, from executors: written whole, renamed last."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyarrow import fs


def resolve(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


@contextmanager
def publishing(uri: str):
    """A stream whose file takes the name `uri` only when all is written: a task that is lost or
    runs twice leaves no half file, and the last complete copy stands."""
    system, path = resolve(uri)
    folder, _, name = path.rpartition("/")
    system.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    stream = system.open_output_stream(draft)
    try:
        yield stream
    except BaseException:
        stream.close()
        system.delete_file(draft)
        raise
    stream.close()
    system.move(draft, path)


def opened(uri: str):
    system, path = resolve(uri)
    return system.open_input_file(path)
