"""WARC files as a Spark data source: ``spark.read.format("warc").load(path)``."""

import zlib

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pagelens import schemas


def filesystem_of(path: str):
    """The file system of a path or URI, and the path on it."""
    from pyarrow import fs
    if "://" in path or path.startswith("file:/"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _open(path: str):
    filesystem, name = filesystem_of(path)
    if name.endswith(".gz"):
        return _Members(filesystem.open_input_file(name))
    return _Plain(filesystem.open_input_stream(name, compression=None))


class Damage(Exception):
    """A stretch of a file that cannot be read; reading goes on behind it."""

    def __init__(self, offset, member):
        super().__init__(f"damaged at byte {offset}")
        self.offset, self.member = offset, member


class _Plain:
    """An uncompressed file: one member, which is never damaged."""
    member, start = 0, 0

    def __init__(self, raw):
        self.raw, self.read = raw, raw.read

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.raw.close()


class _Members:
    """Reads the members of a gzip file one after the other; a cut file gives all that is there.

    A member with wrong data, length or checksum, or bytes that are no member, raise ``Damage`` once. The next read starts
    at the next place that has the mark of a member and unpacks to the head of a record. The search begins right
    behind the mark of the damaged member, as a damaged end may have swallowed members that are sound. ``member`` counts
    the places where unpacking began, ``start`` is the last of them.
    """
    MARK, WINDOW = b"\x1f\x8b\x08", 1 << 16

    def __init__(self, raw):
        self.raw, self.waiting, self.unpack, self.member, self.start = raw, b"", None, 0, 0
        self.given, self.failed = False, False  # Whether data of this member was given out; whether it is known to be damaged.

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.raw.close()

    def _more(self):
        data = self.raw.read(self.WINDOW)
        self.waiting += data
        return bool(data)

    def _begin(self):
        """Whether there is another member; zeros behind the last one are padding."""
        while len(self.waiting) < len(self.MARK) and self._more():
            pass
        while self.waiting and not self.waiting.strip(b"\0"):
            self.waiting = b""
            if not self._more():
                return False
        if not self.waiting:
            return False
        self.member += 1
        self.start = self.raw.tell() - len(self.waiting)
        if not self.MARK.startswith(self.waiting[:len(self.MARK)]):
            self._damaged(self.start)
        self.unpack, self.given, self.failed = zlib.decompressobj(31), False, False
        return True

    def _damaged(self, search_from):
        damage = Damage(self.start, self.member)
        self._search(search_from)
        self.failed = False
        raise damage

    def _search(self, at):
        """Go on at the next place from byte ``at`` on that unpacks to the head of a record, if there is one."""
        self.unpack, self.waiting, tail = None, b"", b""
        self.raw.seek(at)
        while block := self.raw.read(1 << 20):
            tail, at = tail + block, at + len(block)
            place = tail.find(self.MARK)
            while place >= 0:
                found = at - len(tail) + place
                if self._is_record(found):
                    self.raw.seek(found)
                    return True
                place = tail.find(self.MARK, place + 1)
            self.raw.seek(at)
            tail = tail[-len(self.MARK) + 1:]
        return False

    def _is_record(self, offset):
        return self._head(offset, 64).startswith(b"WARC/")

    def _head(self, offset, size):
        """The first bytes of a member, if they can be unpacked."""
        self.raw.seek(offset)
        try:
            return zlib.decompressobj(31).decompress(self.raw.read(self.WINDOW), size)
        except zlib.error:
            return b""

    def read(self, size):
        """Up to ``size`` bytes of one member; nothing at the end of the file."""
        while True:
            if self.failed:
                self._damaged(self.start + 1)
            if self.unpack is None and not self._begin():
                return b""
            if not self.waiting:
                self._more()
            try:
                at_end = not self.waiting
                data = self.unpack.decompress(self.waiting, size)
            except zlib.error:  # What comes before the damage still tells which record is lost.
                self.failed = True
                heads = (self._head(self.start, n) for n in (1 << 12, 1 << 10, 1 << 8))
                data = b"" if self.given else next(filter(None, heads), b"")[:size]
            else:
                self.waiting = self.unpack.unconsumed_tail
            if not self.failed and self.unpack.eof:
                self.waiting, self.unpack = self.unpack.unused_data, None
            if data:
                self.given = True
                return data
            if at_end and not self.failed and self.unpack is not None:  # The file is cut, or a damaged member has swallowed all others.
                damage = Damage(self.start, self.member)
                if self._search(self.start + 1):
                    raise damage
                return b""


def _list(path: str):
    """Files at a path: the file itself, a folder's files, or the matches of a '*' in the last part."""
    import fnmatch
    from pyarrow import fs
    filesystem, name = filesystem_of(path)
    folder, last = name.rsplit("/", 1) if "/" in name else (".", name)
    prefix = path[:len(path) - len(name)] if path.endswith(name) else ""
    if "*" in last:
        found = [i for i in filesystem.get_file_info(fs.FileSelector(folder))
                 if i.is_file and fnmatch.fnmatch(i.base_name, last)]
    else:
        info = filesystem.get_file_info(name)
        found = [info] if info.is_file else [
            i for i in filesystem.get_file_info(fs.FileSelector(name)) if i.is_file]
    return sorted(prefix + i.path for i in found if not i.base_name.startswith(("_", ".")))


class _Lines:
    """Buffered line and block reads over the bytes of a file."""

    def __init__(self, stream):
        self.stream, self.buffer = stream, b""

    def line(self):
        while True:
            end = self.buffer.find(b"\n")
            if end >= 0:
                line, self.buffer = self.buffer[:end], self.buffer[end + 1:]
                return line.rstrip(b"\r")
            more = self.stream.read(1 << 16)
            if not more:
                line, self.buffer = self.buffer, b""
                return line or None
            self.buffer += more

    def block(self, size):
        """The next ``size`` bytes, fewer if the file ends, or a member begins with another record, before."""
        pieces, self.buffer = [self.buffer[:size]], self.buffer[size:]
        size -= len(pieces[0])
        while size:
            member = self.stream.member
            piece = self.stream.read(min(size, 1 << 20))
            if not piece:
                break
            if self.stream.member != member and piece.startswith(b"WARC/"):
                self.buffer = piece
                break
            pieces.append(piece)
            size -= len(piece)
        return b"".join(pieces)


# What became of a record or file: read whole; shorter than announced; not readable; without a length, or no record at
# all; not there.
OK, CUT, DAMAGED, BROKEN, MISSING = "ok", "cut record", "damaged member", "broken header", "missing file"


def warc_records(stream):
    """(status, offset of the member, headers, payload) of each record and of each damaged place.

    A record is sound only when its member has ended well or another record follows in it, so it is given out one
    record later. A cut record has the bytes there are; a place that is damaged or no record has no payload.
    """
    source, waiting, headers, lost = _Lines(stream), [], {}, False
    while True:
        try:
            headers = {}
            line = source.line()
            if line is None:
                break
            if not line.startswith(b"WARC/"):
                if line.strip() and not lost:
                    lost = True
                    waiting.append((stream.member, (BROKEN, stream.start, {}, None)))
                continue
            yield from (found for _, found in waiting)
            waiting, lost = [], False
            offset = stream.start
            while line := source.line():
                name, _, value = line.decode("utf-8", "replace").partition(":")
                headers[name.strip().lower()] = value.strip()
            length = headers.get("content-length", "")
            if not (length.isascii() and length.isdigit()):
                lost = True
                waiting.append((stream.member, (BROKEN, offset, headers, None)))
                continue
            payload = source.block(int(length))
            waiting.append((stream.member, (OK if len(payload) == int(length) else CUT, offset, headers, payload)))
        except Damage as damage:
            source.buffer = b""
            for member, found in waiting:
                if member != damage.member:
                    yield found
                else:
                    headers = headers or found[2]
            waiting, lost = [], False
            yield DAMAGED, damage.offset, headers, None
    yield from (found for _, found in waiting)


def response_rows(path: str, limit: int | None = None, rejects: bool = False):
    """Rows of WARC_RECORD for the response records of one file; with ``rejects`` rows of WARC_STATUS, also for what
    could not be read. ``limit`` counts response records."""
    with _open(path) as stream:
        number = 0
        for status, offset, headers, payload in warc_records(stream):
            if payload is not None:
                if headers.get("warc-type", "").lower() != "response":
                    continue
                number += 1
            elif not rejects or headers.get("warc-type", "response").lower() != "response":
                continue
            row = (path, number if payload is not None else None, headers.get("warc-target-uri"), headers.get("warc-record-id"),
                   headers.get("warc-date"), payload)
            yield row + (status, offset) if rejects else row
            if limit and number >= limit:
                return


class _File(InputPartition):
    def __init__(self, path):
        self.path = path


class _WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        limit = options.get("maxRecordsPerFile")
        self.limit = int(limit) if limit else None
        self.rejects = _with_rejects(options)

    def partitions(self):
        """One task per file; a gzip file cannot be split."""
        return [_File(path) for part in self.path.split(",") for path in _list(part)]

    def read(self, partition):
        yield from response_rows(partition.path, self.limit, self.rejects)


def _with_rejects(options):
    return options.get("rejects", "false").lower() == "true"


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return schemas.WARC_STATUS if _with_rejects(self.options) else schemas.WARC_RECORD

    def reader(self, schema):
        return _WarcReader(self.options)


def read_warc(spark: SparkSession, path: str, max_records_per_file: int | None = None, rejects: bool = False) -> DataFrame:
    """Response records of a file, a folder, or a '*' pattern; several are joined by commas.

    A damaged member of a gzip file costs its own records; reading goes on with the next sound one. With ``rejects`` there
    are the columns ``status`` and ``offset`` (bytes before the member), and a row without payload for each damaged
    place. Errors of the file system are not damage: they fail the task, which Spark repeats.
    """
    spark.dataSource.register(WarcDataSource)
    reader = spark.read.format("warc").option("rejects", str(rejects).lower())
    if max_records_per_file:
        reader = reader.option("maxRecordsPerFile", str(max_records_per_file))
    return reader.load(path)


def read_warc_files(paths: DataFrame, max_records_per_file: int | None = None, rejects: bool = False) -> DataFrame:
    """Response records of the files listed in column ``path``, one file after the other in each task.
    The list stays distributed, so it can be a stream of new files or a large path table. With ``rejects`` as in
    ``read_warc``; a listed file that does not exist is then a row too, with status ``missing file``."""
    schema = schemas.WARC_STATUS if rejects else schemas.WARC_RECORD

    def rows_of(path):
        try:
            yield from response_rows(path, max_records_per_file, rejects)
        except FileNotFoundError:
            if not rejects:
                raise
            yield path, None, None, None, None, None, MISSING, None

    def parse(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                for row in rows_of(path):
                    rows.append(row)
                    size += len(row[5] or b"")
                    if len(rows) >= 1000 or size >= 32 << 20:
                        yield _batch(rows, schema)
                        rows, size = [], 0
                yield _batch(rows, schema)

    return paths.select("path").mapInArrow(parse, schema)


def _batch(rows, schema):
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)], names=arrow.names)


def split_rejects(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records that were read whole, without status and offset, and the table of all that was not: warc_file, offset, url,
    status. Cut records are among the latter."""
    sound = F.col("status") == OK
    return records.filter(sound).drop("status", "offset"), records.filter(~sound).select("warc_file", "offset", "url", "status")


def cap_records(records: DataFrame, n: int = 1000, group: str = "warc_file", order: str = "record_no") -> DataFrame:
    """First ``n`` records of each file. The window limit is applied before the shuffle as well."""
    from pyspark.sql import Window
    first = Window.partitionBy(group).orderBy(order)
    return (records.withColumn("_n", F.row_number().over(first))
            .filter(F.col("_n") <= n).drop("_n"))
