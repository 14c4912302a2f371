"""Files that tasks write to and read from the shared folder, whatever its store."""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path (plain, file:, hdfs:, s3: and others) and the path there."""
    if "://" not in path:
        path = path.removeprefix("file:")
        return fs.LocalFileSystem(), path
    if path.startswith("file://"):
        return fs.LocalFileSystem(), path.removeprefix("file://")
    return fs.FileSystem.from_uri(path)


def write_file(folder: str, name: str, data: bytes) -> str:
    """Write a new file; its name holds a random part, so that attempts never meet.

    Only the names of attempts that succeeded reach the manifest Spark commits;
    what a lost or repeated attempt left behind is never read.
    """
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    system, place = opened(path)
    system.create_dir(place.rpartition("/")[0], recursive=True)
    with system.open_output_stream(place) as out:
        out.write(data)
    return path


def remove_folder(path: str) -> None:
    """Delete a folder that nothing reads any more."""
    system, place = opened(path)
    system.delete_dir(place)
