"""Names-only listings and removals in table folders, through Hadoop's file systems.

A listing is made and joined to one text in the JVM: it takes the same few calls from
Python, however many names there are.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from py4j.java_gateway import JavaClass
from pyspark.sql import SparkSession

_INPUT_PATHS = "mapreduce.input.fileinputformat.inputdir"


def _class(spark: SparkSession, name: str) -> JavaClass:
    """A class of Hadoop, without looking its package up part by part."""
    return JavaClass(f"org.apache.hadoop.{name}", spark.sparkContext._gateway._gateway_client)


def _opened(spark: SparkSession, folder: str):
    path = _class(spark, "fs.Path")(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    system, path = _opened(spark, folder)
    return system.exists(path)


def literal(name: str) -> str:
    """A name as a glob that matches it alone."""
    return re.sub(r"([\\*?\[\]{},])", r"\\\1", name)


def _paths(spark: SparkSession, statuses) -> list[str]:
    """The paths in an array of file statuses, handed over as one text: the list of input paths
    that Hadoop writes into a job's settings, with commas and backslashes escaped."""
    if statuses is None or not len(statuses):
        return []
    job = _class(spark, "mapred.JobConf")(False)
    _class(spark, "mapred.FileInputFormat").setInputPaths(job, _class(spark, "fs.FileUtil").stat2Paths(statuses))
    paths = re.findall(r"(?:[^\\,]|\\.)+", job.getRaw(_INPUT_PATHS), re.DOTALL)
    return [re.sub(r"\\(.)", r"\1", path, flags=re.DOTALL) for path in paths]


def children(spark: SparkSession, folder: str) -> list[str]:
    """The names of what lies directly in a folder; nothing if there is none."""
    system, path = _opened(spark, folder)
    if not system.exists(path):
        return []
    return [name.rpartition("/")[2] for name in _paths(spark, system.listStatus(path))]


def is_folder(spark: SparkSession, path: str) -> bool:
    system, opened = _opened(spark, path)
    return system.getFileStatus(opened).isDirectory()


def walk(spark: SparkSession, folder: str) -> list[str]:
    """The paths, within the folder, of the files below it that Spark reads, as its own parallel listing finds them."""
    system, path = _opened(spark, folder)
    if not system.exists(path):
        return []
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(literal(folder))._jdf.inputFiles()
    root = system.resolvePath(path).toUri().getPath().rstrip("/") + "/"
    joined = _class(spark, "util.StringUtils").join("\0", found)
    # URLs; a path of this kind has no scheme in its first part but a colon
    paths = (unquote(re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", url)) for url in joined.split("\0") if url)
    return [path.removeprefix(root) for path in paths]


def hidden_below(spark: SparkSession, folder: str, visible: list[str] | None = None) -> list[str]:
    """The paths, within the folder, of the files and folders that Spark's sources pass over; a few
    calls per folder.  ``visible`` is what ``walk`` has found."""
    files = set(walk(spark, folder) if visible is None else visible)
    found, waiting = [], [""]
    while waiting:
        at = waiting.pop()
        for name in children(spark, f"{folder}/{at}"):
            if hidden(name):
                found.append(at + name)
            elif at + name not in files:  # no file that Spark reads, so a folder
                waiting.append(f"{at}{name}/")
    return sorted(found)


def hidden(name: str) -> bool:
    """Whether Spark's file sources pass a name over."""
    return name.startswith(("_", ".")) and "=" not in name


def data_files(spark: SparkSession, folder: str) -> dict[str, frozenset[str]]:
    """The names of the data files by the partition folder they lie in."""
    found: dict[str, set[str]] = {}
    for path in walk(spark, folder):
        if not any(map(hidden, path.split("/"))):
            inner, _, name = path.rpartition("/")
            found.setdefault(f"{folder}/{inner}" if inner else folder, set()).add(name)
    return {at: frozenset(names) for at, names in found.items()}


def move(spark: SparkSession, source: str, target: str) -> None:
    system, path = _opened(spark, source)
    _, to = _opened(spark, target)
    system.mkdirs(to.getParent())
    if not system.rename(path, to):
        raise OSError(f"cannot move {source} to {target}")


def remove(spark: SparkSession, folder: str) -> None:
    system, path = _opened(spark, folder)
    system.delete(path, True)


def remove_at_exit(spark: SparkSession, folder: str) -> None:
    """Makes the folder, and has it removed when the driver's JVM ends."""
    system, path = _opened(spark, folder)
    system.mkdirs(path)
    system.deleteOnExit(path)


def write_text(spark: SparkSession, file: str, text: str) -> None:
    system, path = _opened(spark, file)
    stream = system.create(path, True)
    stream.write(text.encode())
    stream.close()


def replace_text(spark: SparkSession, file: str, text: str) -> None:
    """Writes a small file beside an older one of that name and puts it in its place; cut short
    in between, ``read_text`` finds the new one."""
    write_text(spark, f"{file}.new", text)
    remove(spark, file)
    move(spark, f"{file}.new", file)


def read_text(spark: SparkSession, file: str) -> str | None:
    system, path = _opened(spark, file)
    if not system.exists(path):
        system, path = _opened(spark, f"{file}.new")
        if not system.exists(path):
            return None
    size = int(system.getFileStatus(path).getLen())
    stream = system.open(path)
    try:
        return bytes(stream.readNBytes(size)).decode()
    finally:
        stream.close()
