"""Small files in folders that driver and workers share."""

import os
import uuid

from pyarrow import fs


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI as Spark writes them, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def read_file(files: fs.FileSystem, path: str) -> bytes:
    with files.open_input_stream(path) as f:
        return f.read()


def write_file(files: fs.FileSystem, path: str, data: bytes) -> None:
    with files.open_output_stream(path) as f:
        f.write(data)


def names(files: fs.FileSystem, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    return sorted(i.base_name for i in files.get_file_info(fs.FileSelector(folder, allow_not_found=True)))


def remove_folder(files: fs.FileSystem, path: str) -> None:
    if files.get_file_info(path).type == fs.FileType.Directory:
        files.delete_dir(path)


def create_once(files: fs.FileSystem, path: str, data: bytes) -> bool:
    """Creates a file whole or not at all; False if it is there already, whoever made it.

    A link on a local or mounted file system, elsewhere a move, which must
    refuse an existing target, as HDFS does.
    """
    part = f"{path}.{uuid.uuid4().hex}.part"
    write_file(files, part, data)
    try:
        if isinstance(files, fs.LocalFileSystem):
            os.link(part, path)
        else:
            if files.get_file_info(path).type != fs.FileType.NotFound:
                return False
            files.move(part, path)
        return True
    except OSError:
        if files.get_file_info(path).type == fs.FileType.NotFound:
            raise
        return False
    finally:
        if files.get_file_info(part).type != fs.FileType.NotFound:
            files.delete_file(part)
