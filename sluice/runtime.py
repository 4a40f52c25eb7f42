"""What a job needs from its session: a shared scratch folder, a fixed clock, file-system calls."""

from __future__ import annotations

import datetime as dt
import re
import tempfile
import uuid
from functools import cache

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# ASCII characters that a URI's path holds only in quoted form.
_ILLEGAL = re.compile(r'[\x00-\x20\x7f"#%<>?\[\\\]^`{|}]')


@cache
def _local_scratch() -> str:
    """One temporary folder per process; a running session does not let this setting be made."""
    return tempfile.mkdtemp(prefix="sluice-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path in the folder that every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local master, where
    driver and executors are one process, may fall back on a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_scratch()
    return f"{root.rstrip('/')}/sluice/{label}-{uuid.uuid4().hex[:12]}"


def clock_now(spark: SparkSession) -> dt.datetime:
    """The run clock: wall time in the session's time zone, whatever zone the driver is in."""
    return spark.sql("SELECT CAST(current_timestamp() AS timestamp_ntz) AS now").head()["now"]


def clock_column(clock: dt.datetime) -> Column:
    """The run clock as a constant timestamp, read in the session time zone."""
    return F.lit(clock.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def own_session(spark: SparkSession) -> SparkSession:
    """A session with the settings of this one, on the same context: what it sets stays its own."""
    mine = spark.newSession()
    there = mine.conf.getAll
    for name, value in spark.conf.getAll.items():
        if there.get(name) != value and mine.conf.isModifiable(name):
            mine.conf.set(name, value)
    return mine


class Folder:
    """The few file-system calls a table needs, made on whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        root = self._path(path)
        self._fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        self._root = self._fs.makeQualified(root)
        self.path = path.rstrip("/")

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _at(self, relative: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, relative) if relative else self._root

    def uri_path(self, relative: str = "") -> str:
        """Path part of the full URI, as file metadata columns report it."""
        return self._at(relative).toUri().getPath()

    def encoded(self, relatives: list[str]) -> list[str]:
        """Relative paths as the URIs of file metadata columns spell them."""
        plain = lambda r: _ILLEGAL.sub(lambda m: f"%{ord(m[0]):02X}", r)
        uri = lambda r: self._at(r).toUri().toString().split("/")[-r.count("/") - 1 :]
        return [plain(r) if r.isascii() else "/".join(uri(r)) for r in relatives]

    def exists(self, relative: str = "") -> bool:
        return self._fs.exists(self._at(relative))

    def is_file(self, relative: str = "") -> bool:
        return self.exists(relative) and self._fs.getFileStatus(self._at(relative)).isFile()

    def listing(self, pattern: str) -> list[tuple[str, bool, int, int]]:
        """``(relative path, is_dir, bytes, modified ms)`` of everything that matches a glob."""
        base = len(self.uri_path()) + 1
        found = self._fs.globStatus(self._at(pattern)) or []
        path = lambda status: status.getPath().toUri().getPath()[base:]
        return [(path(s), s.isDirectory(), s.getLen(), s.getModificationTime()) for s in found]

    def data_files(self, relative: str) -> list[str]:
        """Relative paths of the data files directly inside a folder."""
        base = len(self.uri_path()) + 1
        found = self._fs.listStatus(self._at(relative))
        names = [s.getPath().toUri().getPath()[base:] for s in found]
        return [n for n in names if not n.rsplit("/", 1)[-1].startswith(("_", "."))]

    def usage(self, relative: str) -> tuple[int, int]:
        """Number and bytes of the files at a path, in one call."""
        summary = self._fs.getContentSummary(self._at(relative))
        return summary.getFileCount(), summary.getLength()

    def read_text(self, relative: str) -> str:
        stream = self._fs.open(self._at(relative))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, relative: str, text: str) -> None:
        """Create a whole file at once; one that has the name already is an error.

        The text goes to a hidden file first, so a writer that dies leaves no half of it.
        """
        folder, _, name = relative.rpartition("/")
        draft = f"{folder}/.{uuid.uuid4().hex}" if folder else f".{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(draft), False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        hadoop = self._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(self._fs.getUri(), self._fs.getConf())
        plain = self._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            context.rename(self._at(draft), self._at(relative), plain)
        except Py4JJavaError as err:
            self._fs.delete(self._at(draft), False)
            if "FileAlreadyExists" in str(err.java_exception):
                raise FileExistsError(f"{self.path}/{relative}") from err
            raise

    def delete(self, relative: str = "") -> None:
        self._fs.delete(self._at(relative), True)
