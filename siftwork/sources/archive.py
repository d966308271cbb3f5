"""Crawl archives read by record length, many tasks to a compressed file.

Archives are written as one gzip member per record (or a few), so a file can be entered wherever a member begins. Nothing in the
file says where that is, and a payload may hold bytes that look like it, so members are found in two passes over ranges of
the files. In the first, the task of a range starts at the first place that looks like a member with a record, reads on to the
first member beyond the range that begins a record, and reports both places. A range is right if it starts where the range
before it ended; so, from the first range on, the starts of a file are proven one after the other, and from the first that
fails, the rest of the file is read by one task. The second pass reads the records. What a task holds is one record and a few rows. A file that is not compressed, or is one
member, is one range.

Records without an id get one from their file, the place of their member in it, and their number in that member.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "type string, url string, date string, record_id string, payload binary, file string"
#: Bytes of a file that a task reads.
SPLIT_BYTES = 64 << 20


def _reader():
    """``(find, read)`` of a file's ranges. They are made here so that they travel to the executors by value."""
    magic, chunk = b"\x1f\x8b\x08", 1 << 20

    class File:
        def __init__(self, path: str):
            from pyarrow import fs

            store, base = fs.FileSystem.from_uri(path)
            self.path, self.stream = path, store.open_input_file(base)
            self.size = self.stream.size()
            self.packed = self.at(0, 3) == magic

        def at(self, place: int, n: int) -> bytes:
            self.stream.seek(place)
            return self.stream.read(n)

    def holds_record(file: File, place: int) -> bool:
        """Whether a member with a record stands here, and another member or the end of the file behind it."""
        import zlib

        unpack, read, first = zlib.decompressobj(31), place, b""
        try:
            while not unpack.eof:
                packed = file.at(read, 1 << 16)
                read += len(packed)
                while packed and not unpack.eof:
                    data = unpack.decompress(packed, 4 * chunk)
                    first = first if len(first) >= 5 else first + data[:5]
                    packed = unpack.unconsumed_tail
                if not packed and not unpack.eof and read >= file.size or not b"WARC/".startswith(first[:5]):
                    return False
        except zlib.error:
            return False
        behind = read - len(unpack.unused_data)
        return first[:5] == b"WARC/" and file.at(behind, 3) in (magic, b"")

    def find(file: File, start: int, end: int) -> int:
        """The first place of a range that looks like a member with a record, or -1."""
        if start == 0:
            return 0
        place = start
        while file.packed and place < end:
            data = file.at(place, min(chunk, end - place) + len(magic) - 1)
            found = data.find(magic)
            while found >= 0 and place + found < end:
                if holds_record(file, place + found):
                    return place + found
                found = data.find(magic, found + 1)
            place += chunk
        return -1

    def pieces(file: File, place: int) -> Iterator[tuple[int, bytes, bool]]:
        """``(place of the member, its next bytes, whether it begins)`` from a place to the end of the file."""
        import zlib

        if not file.packed:
            while data := file.at(place, chunk):
                yield 0, data, place == 0
                place += len(data)
            return
        while place < file.size:
            unpack, read, begins = zlib.decompressobj(31), place, True
            while not unpack.eof:
                packed = file.at(read, chunk)
                if not packed:
                    raise EOFError(f"{file.path} ends inside a member")
                read += len(packed)
                while packed and not unpack.eof:  # a little input may hold a lot
                    yield place, unpack.decompress(packed, 4 * chunk), begins
                    packed, begins = unpack.unconsumed_tail, False
            place = read - len(unpack.unused_data)
            while place < file.size and file.at(place, 1) == b"\0":  # padding
                place += 1

    def read(file: File, begin: int, end: int) -> Iterator[tuple]:
        """The records that begin in members from ``begin`` to before ``end``, and at last the place where the next one begins."""
        import re

        def field(head: bytes, name: bytes) -> str:
            found = re.search(rb"(?im)^" + name + rb":[ \t]*([^\r\n]*?)[ \t]*\r?$", head)
            return found.group(1).decode("utf-8", "replace") if found else ""

        held, head, need, home, number = bytearray(), None, 0, begin, 0
        for place, data, begins in pieces(file, begin):
            if begins and head is None and not held.strip():
                if place >= end and file.packed:
                    yield (place,)
                    return
                home, number = place, 0
            held += data
            while True:
                if head is None:
                    found = held.find(b"WARC/")
                    if found < 0:
                        if len(held) > 4:
                            del held[:len(held) - 4]
                        break
                    stop = held.find(b"\r\n\r\n", found)
                    if stop < 0:
                        break
                    head = bytes(held[found:stop])
                    need = int(field(head, b"Content-Length") or 0)
                    del held[:stop + 4]
                if len(held) < need:
                    break
                name = field(head, b"WARC-Record-ID") or f"{file.path}@{home}+{number}"
                yield field(head, b"WARC-Type"), field(head, b"WARC-Target-URI"), field(head, b"WARC-Date"), name, bytes(held[:need]), file.path
                del held[:need]
                head, number = None, number + 1
        if head is not None:
            raise EOFError(f"{file.path} ends inside a record")
        yield (file.size,)

    return File, find, read


def _ranges(paths: list[tuple[str, int]], split: int) -> list[tuple[str, int, int]]:
    """Ranges of the files; a file that cannot be entered in the middle is one."""
    found = []
    for path, size in paths:
        step = split if path.endswith(".gz") else max(size, 1)
        found += [(path, at, min(at + step, size)) for at in range(0, size, step)]
    return found


def _looked_up(ranges: DataFrame) -> DataFrame:
    """``(path, start, end, begin, next)``: where the members of a range seem to begin, and where those of the next one do."""
    File, find, read = _reader()

    def look(batches):
        import pandas as pd

        for batch in batches:
            for path, start, end in zip(batch["path"], batch["start"], batch["end"]):
                file = File(path)
                begin, onward = find(file, start, end), -1
                if begin >= 0:
                    try:
                        for row in read(file, begin, end):
                            onward = row[0] if len(row) == 1 else -1
                    except Exception:  # not a member after all, or a broken file: reading from its start will tell
                        onward = -1
                yield pd.DataFrame([(path, start, end, begin, onward)], columns=["path", "start", "end", "begin", "next"])

    return ranges.mapInPandas(look, "path string, start long, end long, begin long, next long")


def _proven(found: DataFrame) -> DataFrame:
    """``(path, begin, end)``: the ranges that members begin in, by file in order; where ranges do not join, the rest is one."""

    def chain(rows):
        import pandas as pd

        rows, place, kept = rows.sort_values("start"), 0, []
        for r in rows.itertuples():
            if place >= r.end:
                continue  # a record of an earlier range covers this one
            if r.begin != place or r.next < 0:
                kept.append((r.path, place, int(rows["end"].max())))
                break
            kept.append((r.path, place, r.end))
            place = r.next
        return pd.DataFrame(kept, columns=["path", "begin", "end"])

    return found.groupBy("path").applyInPandas(chain, "path string, begin long, end long")


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the cluster's file system if it has none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = place.makeQualified(store.getUri(), store.getWorkingDirectory()).toString()
    return "file://" + found.removeprefix("file:") if found.startswith("file:/") and not found.startswith("file://") else found


def read_archive(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``(type, url, date, record_id, payload, file)`` of every record of a file or folder, read by length.

    Ranges of files with more than one are looked up when this is called. The file system must be one that pyarrow reads too.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    # names and lengths only: contents are not read
    listed = [(qualified(spark, r["path"]), r["length"]) for r in files.where("length > 0").collect()]
    ranges = _ranges(sorted(listed), split_bytes)
    if not ranges:
        return spark.createDataFrame([], SCHEMA)
    cut = {r[0] for r in ranges if r[1] > 0}
    several = [r for r in ranges if r[0] in cut]
    parts = [r for r in ranges if r[0] not in cut]
    spread = lambda rows: spark.createDataFrame(rows, "path string, start long, end long").repartition(len(rows))
    if several:
        parts += [tuple(r) for r in _proven(_looked_up(spread(several))).collect()]  # a row per range
    File, _, read = _reader()
    ddl = SCHEMA

    def rows(batches):
        import pyarrow as pa

        names = [part.split()[0] for part in ddl.split(", ")]
        kinds = [pa.binary() if n == "payload" else pa.string() for n in names]
        pack = lambda held: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
        for batch in batches:
            for r in batch.to_pylist():
                held, weight = [], 0
                for row in read(File(r["path"]), r["start"], r["end"]):
                    if len(row) == 1:
                        break
                    held.append(row)
                    weight += len(row[4])
                    if len(held) >= 512 or weight >= 1 << 24:
                        yield pack(held)
                        held, weight = [], 0
                if held:
                    yield pack(held)

    return spread(sorted(parts)).mapInArrow(rows, SCHEMA)
