"""The few file-system calls Spark's writers do not offer: existence, listing, publish by rename.

All go through the Hadoop file system of the path, so they work on whatever store the
cluster uses. On a store whose rename is not atomic a reader may see a folder before it is
whole; writers never take such a folder for a published one.

On a local disk Hadoop's rename is a look and then a move, in two steps for a file and its checksum, so there the small
files are claimed by a link and replaced by a move of the system's own. A claimed file gets its checksum afterwards, a
replaced one carries none.
"""

import contextlib
import os
import struct
import uuid
import zlib

from py4j.protocol import Py4JJavaError

#: An empty file that is written last into a published folder; readers skip names like this.
MARKER = "_PUBLISHED"


def _open(spark, path):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark, path):
    fs, target = _open(spark, path)
    return fs.exists(target)


def child_names(spark, path):
    """Names of the visible entries of a folder, sorted; empty if the folder is not there."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    names = [entry.getPath().getName() for entry in fs.listStatus(target)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def remove(spark, path):
    fs, target = _open(spark, path)
    return fs.delete(target, True)


def is_published(spark, path):
    """Whether a folder was published whole: its marker is there."""
    return exists(spark, f"{path}/{MARKER}")


def publish(spark, staging, final):
    """Make a finished folder visible under its final name, then mark it as whole.

    Where renaming copies file by file, a crash can leave part of a folder; without the
    marker that is no published folder, and the next attempt replaces it.
    """
    if is_published(spark, final):
        raise FileExistsError(final)
    fs, source = _open(spark, staging)
    _, target = _open(spark, final)
    if fs.exists(target):
        fs.delete(target, True)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"could not rename {staging} to {final}")
    _, marker = _open(spark, f"{final}/{MARKER}")
    fs.create(marker, True).close()


def make_folder(spark, path):
    fs, target = _open(spark, path)
    fs.mkdirs(target)


def create_once(spark, path, text):
    """Write a small file unless one of that name is there, and say whether it was written.

    The text is written aside and takes its name by a step that replaces nothing, so of several writers one succeeds,
    and a reader finds the whole text or none.
    """
    fs, target = _open(spark, path)
    local = _local(fs, target)
    if local:
        aside = _aside(local, text)
        try:
            os.link(aside, local)
            _add_checksum(local, text.encode())
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(aside)
    jvm = spark.sparkContext._jvm
    aside = f"{target.getParent()}/_{uuid.uuid4().hex}"
    _write(fs, jvm.org.apache.hadoop.fs.Path(aside), text)
    try:
        _rename(spark, aside, path, "NONE")
        return True
    except Py4JJavaError as error:
        fs.delete(jvm.org.apache.hadoop.fs.Path(aside), False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName() or fs.exists(target):
            return False
        raise


def replace_file(spark, path, text):
    """Write a small file in place of one of that name, by a rename; a reader finds the old text or the new one."""
    fs, target = _open(spark, path)
    local = _local(fs, target)
    if local:
        aside = _aside(local, text)
        with contextlib.suppress(FileNotFoundError):
            os.unlink(_checksum_of(local))
        os.replace(aside, local)
        return
    aside = f"{target.getParent()}/_{uuid.uuid4().hex}"
    _write(fs, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(aside), text)
    _rename(spark, aside, path, "OVERWRITE")


def read_file(spark, path):
    """The text of a small file; None if it is not there."""
    fs, target = _open(spark, path)
    local = _local(fs, target)
    if local:
        try:
            with open(local, encoding="utf-8") as file:
                return file.read()
        except FileNotFoundError:
            return None
    try:
        stream = fs.open(target)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileNotFoundException":
            return None
        raise
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _local(fs, target):
    """The path of a file on the driver's own disk; None on any other store."""
    return target.toUri().getPath() if fs.getUri().getScheme() == "file" else None


def _checksum_of(path):
    return f"{os.path.dirname(path)}/.{os.path.basename(path)}.crc"


def _add_checksum(path, data, stretch=512):
    """What Hadoop's readers of a local disk hold a file against; without it they read all the same."""
    sums = (zlib.crc32(data[at:at + stretch]) for at in range(0, len(data), stretch))
    os.replace(_aside(path, b"crc\0" + struct.pack(">i", stretch) + b"".join(struct.pack(">I", s) for s in sums)),
               _checksum_of(path))


def _aside(path, text):
    """The text in a file of its own beside `path`."""
    folder = os.path.dirname(path)
    os.makedirs(folder, exist_ok=True)
    aside = f"{folder}/_{uuid.uuid4().hex}"
    with open(aside, "xb") as file:
        file.write(text.encode() if isinstance(text, str) else text)
        file.flush()
        os.fsync(file.fileno())
    return aside


def _write(fs, target, text):
    stream = fs.create(target, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _rename(spark, source, final, option):
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(kind, 1)
    options[0] = kind.valueOf(option)
    path = jvm.org.apache.hadoop.fs.Path
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(final).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(path(source), path(final), options)
