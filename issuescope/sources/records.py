"""Records of delimited text files, read in pieces though quoted fields may hold line breaks.

Spark cuts text files at lines wherever it likes, so a piece may begin inside a quoted field.  Whether it does depends on
all pieces of the file before it, but only through one bit.  A first scan finds, for every piece and for both
values of the bit at its start, the bit at its end and what a record cut by its borders looks like; the bits are then
chained through the file; a second scan puts the lines of every piece together from the right bit on.  Records that
cross a border are put together from the first scan's few rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_table

_PLACE_BITS = 33
_LAST_PLACE = (1 << _PLACE_BITS) - 1
_BOM = b"\xef\xbb\xbf"

_PIECES = (
    "file string, start bigint, end_0 int, end_1 int, closes boolean, n_lines bigint, "
    "head binary, tail_0 binary, tail_1 binary"
)


class LineScanner:
    """Follows quoted fields from line to line.

    A quote opens a field only at its start; two quotes inside a quoted field stand for one; what follows a closing
    quote belongs to the field up to the next separator.
    """

    def __init__(self, sep: str):
        s = re.escape(sep.encode())
        inside = rb'[^"]*+(?:""[^"]*+)*+"[^' + s + rb"]*+"
        field = rb'(?:"' + inside + rb'|[^"' + s + rb"][^" + s + rb"]*+|)"
        more = rb"(?:" + s + field + rb")*+\Z"
        self._from = (re.compile(field + more), re.compile(inside + more))

    def after(self, line: bytes, quoted: bool) -> bool:
        """Whether the line ends inside a quoted field, when it begins inside one or not."""
        return self._from[quoted].match(line) is None


def _lines(spark: SparkSession, path: str, line_sep: str) -> DataFrame:
    text = spark.read.option("lineSep", line_sep).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"),
    )


def _by_piece(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[bytes], np.ndarray]]:
    """((file, start), lines, which of them hold a quote) in file order, several times per piece."""
    for batch in batches:
        if not batch.num_rows:
            continue
        start = batch.column("start").to_numpy()
        file = batch.column("file").dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero((np.diff(start) != 0) | (np.diff(file) != 0)) + 1
        line = batch.column("line")
        marked = pc.fill_null(pc.match_substring(line, pattern=b'"'), False).to_numpy(zero_copy_only=False)
        values = line.to_pylist()
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            yield (batch.column("file")[a].as_py(), int(start[a])), values[a:b], marked[a:b]


class _Run:
    """One assumption about a piece's first bit, followed to its end."""

    def __init__(self, quoted: bool):
        self.quoted, self.at_border = quoted, quoted
        self.head: list[bytes] = []
        self.open: list[bytes] = []

    def plain(self, lines: list[bytes]) -> None:
        """Lines without quotes."""
        if self.quoted:
            (self.head if self.at_border else self.open).extend(lines)

    def marked(self, line: bytes, ends_quoted: bool) -> None:
        if self.at_border:
            self.head.append(line)
            self.at_border = ends_quoted
            self.open = []
        elif self.quoted:
            self.open.append(line)
        else:
            self.open = [line]
        if not ends_quoted:
            self.open = []
        self.quoted = ends_quoted


def _scan_pieces(sep: str, line_end: bytes):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = LineScanner(sep)
        key, runs, n_lines = None, (), 0

        def row() -> pa.RecordBatch:
            zero, one = runs

            def text(lines: list[bytes], there: bool) -> list[bytes | None]:
                return [line_end.join(lines) if there else None]

            columns = [
                [key[0]],
                [key[1]],
                [int(zero.quoted)],
                [int(one.quoted)],
                [not one.at_border],
                [n_lines],
                text(one.head, True),
                text(zero.open, zero.quoted),
                text(one.open, one.quoted and not one.at_border),
            ]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int64(), *[pa.binary()] * 3]
            names = [c.split()[0] for c in _PIECES.split(", ")]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for at, lines, marked in _by_piece(batches):
            if at != key:
                if key is not None:
                    yield row()
                key, runs, n_lines = at, (_Run(False), _Run(True)), 0
                if at[1] == 0 and lines[0].startswith(_BOM):
                    lines[0] = lines[0].removeprefix(_BOM)
            n_lines += len(lines)
            place = 0
            for i in np.flatnonzero(marked).tolist():
                for run in runs:
                    run.plain(lines[place:i])
                zero, one = (run.quoted for run in runs)
                ends = scanner.after(lines[i], zero)
                runs[0].marked(lines[i], ends)
                runs[1].marked(lines[i], ends if one == zero else scanner.after(lines[i], one))
                place = i + 1
            for run in runs:
                run.plain(lines[place:])
        if key is not None:
            yield row()

    return scan


def _chain(pieces: list) -> tuple[dict[tuple[str, int], tuple[int, bool]], list[tuple[str, int, str, int, int]]]:
    """(number and first bit by piece, [(file, start, part, record, place)]) of the pieces in file order.

    ``part`` names the column with a part of a record that crosses borders; ``record`` numbers these records.
    """
    known, parts = {}, []
    file, quoted, record = None, False, -1
    for number, p in enumerate(pieces):
        if p.file != file:
            file, quoted = p.file, False
        known[p.file, p.start] = (number, quoted)
        if quoted:
            parts.append((p.file, p.start, "head", record, len(parts)))
        ends = bool(p.end_1 if quoted else p.end_0)
        if ends and (not quoted or p.closes):
            record = number
            parts.append((p.file, p.start, "tail_1" if quoted else "tail_0", record, len(parts)))
        quoted = ends
    # A record still open where its file ends is whole as it is.
    return known, parts


def _assemble(sep: str, line_end: bytes, known: dict[tuple[str, int], tuple[int, bool]]):
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = LineScanner(sep)
        key, number, place = None, 0, 0
        quoted = skipping = header = False
        buffer: list[bytes] = []
        for at, lines, marked in _by_piece(batches):
            if at != key:
                key, place, buffer = at, 0, []
                if at not in known:
                    raise RuntimeError("the files are cut otherwise than when they were opened; read them again")
                number, quoted = known[at]
                skipping, header = quoted, at[1] == 0
                if header and lines[0].startswith(_BOM):
                    lines[0] = lines[0].removeprefix(_BOM)
            records: list[bytes] = []
            held = 0

            def plain(run: list[bytes]) -> None:
                nonlocal held
                if not quoted:
                    records.extend(run)
                elif not skipping:
                    buffer.extend(run)

            for i in np.flatnonzero(marked).tolist():
                plain(lines[held:i])
                ends = scanner.after(lines[i], quoted)
                if not skipping:
                    buffer.append(lines[i])
                    if not ends:
                        records.append(line_end.join(buffer))
                        buffer = []
                elif not ends:
                    skipping = False
                quoted = ends
                held = i + 1
            plain(lines[held:])
            records = [r.removesuffix(b"\r") for r in records if r not in (b"", b"\r")]
            if header and records:
                records, header = records[1:], False
            rows = (number << _PLACE_BITS) + place + np.arange(len(records))
            place += len(records)
            if records:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.int64()), pa.array(records, pa.binary())], names=["row_id", "record"]
                )

    return assemble


def read_records(spark: SparkSession, path: str, sep: str, line_sep: str = "\n") -> DataFrame:
    """(row_id, record): the records of a file or a folder, as bytes without their line end.

    Blank lines and the first record of every file, its header, are left out; a header lies in its file's first piece.

    ``row_id`` grows with the path, the place in the file and nothing else, but has gaps.  Files are scanned twice;
    neither scan shuffles lines.  One short row per piece comes to the driver, where Spark itself keeps far more for the
    task that reads the piece.  The pieces must be cut alike both times, so settings for the size of input splits
    must not change between this call and the use of its result; the job then ends with an error.
    """
    lines, line_end = _lines(spark, path, line_sep), line_sep.encode()
    pieces = stage_table(lines.mapInArrow(_scan_pieces(sep, line_end), _PIECES), "file-pieces")
    bits = sorted(pieces.select("file", "start", "end_0", "end_1", "closes").collect(), key=lambda p: (p.file, p.start))
    known, parts = _chain(bits)
    records = lines.mapInArrow(_assemble(sep, line_end, known), "row_id bigint, record binary")
    if parts:
        table = pa.table(
            dict(zip(("file", "start", "part", "record", "place"), map(list, zip(*parts, strict=True)), strict=True))
        )
        wanted = spark.createDataFrame(table, "file string, start bigint, part string, record bigint, place bigint")
        text = F.when(F.col("part") == "head", F.col("head")).when(F.col("part") == "tail_0", F.col("tail_0"))
        joined = wanted.join(pieces, ["file", "start"]).select(
            "record", "place", text.otherwise(F.col("tail_1")).alias("text")
        )
        # Bytes as hex digits while they are joined, as they need not be UTF-8.
        texts = F.array_sort(F.collect_list(F.struct("place", F.hex("text").alias("text"))))
        digits = F.array_join(F.transform(texts, lambda t: t["text"]), line_end.hex())
        whole = joined.groupBy("record").agg(digits.alias("digits"))
        crossing = whole.select(
            F.shiftleft("record", _PLACE_BITS).bitwiseOR(F.lit(_LAST_PLACE)).alias("row_id"),
            F.unhex(F.regexp_replace("digits", "0D$", "")).alias("record"),
        )
        records = records.unionByName(crossing)
    return records
