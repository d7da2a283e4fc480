"""Token ids of whole texts, and a bit-plane file format for them."""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lanes, map_batches

#: Words whose ids a task remembers in Arrow arrays, of 40 bytes or so each; those not met for longest go first.
KNOWN_WORDS = 450_000
#: Bytes of texts that are encoded together.
GROUP_BYTES = 6 << 20
#: Parts of words that are remembered besides; when as many are new, the older half is forgotten.
WORD_CACHE = 100_000
_LONG_PIECE = 64
#: Longer words with marks beside them seldom come again and are put together from their parts each time.
_SHORT_WORD = 6
#: Letters for which the patterns below and those of the library agree in any version of Unicode.
_COMMON = regex.compile(r"[\x00-\x7f\u00c0-\u017f]*")
#: The split patterns of both vocabularies.
_SPLITS = {
    "dropped": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
    "kept": r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
}


def _file_of(name: str) -> str:
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else the next free one."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Words(dict):
    """word -> ids as little-endian 32-bit integers, for the words used last.

    The encoder also says whether a word is worth remembering.
    """

    def __init__(self, encode: Callable[[str], tuple[bytes, bool]], most: int):
        super().__init__()
        self.encode, self.most, self.older = encode, most, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids, again = self.encode(word)
            if not again:
                return ids
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids


class _Spelled(dict):
    """character -> its bytes in the letters of byte-level vocabularies; others than those given are spelled as they come."""

    def __missing__(self, char: str) -> str:
        letters = byte_letters()
        return "".join(letters[b] for b in char.encode())


#: What a word is split into is held in the same table.
_Pieces = _Words


@lru_cache(maxsize=4)
def tokenizer_ids(name: str) -> Callable[[str], bytes]:
    """text -> ids by the tokenizers library as little-endian 32-bit integers, without special tokens added.

    ``name`` is a file of the public_tokenizers package or a path.  Text is encoded piece by piece and pieces are
    remembered, as most of them are words that come again (``encoded_texts`` does so for many texts at once).  It is cut
    only where the ids of the parts are those of the whole: pre-tokenizers that drop white space never look across it, and
    byte-level ones join one blank to the word behind it, while a single line feed between other characters stands alone.
    Pieces of ordinary letters go straight to the library's merges, all others through the whole of its pipeline.
    """
    import json

    from tokenizers import Tokenizer

    path = _file_of(name)
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        kind = "dropped" if '"Split"' in json.dumps(json.load(file)["pre_tokenizer"]) else "kept"
    split, letters, merges = regex.compile(_SPLITS[kind]).findall, byte_letters(), tokenizer.model.tokenize
    normal = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str

    # Of common letters, lower case in Python is what the normalizer makes of a text, unless a version of either differs.
    common = [chr(c) for c in (*range(128), *range(0xC0, 0x180))]
    lower = str.lower if all(normal(c) == c.lower() for c in common if not c.isspace()) else normal
    spelled = _Spelled({c: "".join(letters[b] for b in c.encode()) for c in common}).__getitem__

    def merged(part: str) -> bytes:
        return array("I", [t.id for t in merges("".join(map(spelled, part)))]).tobytes()

    def encode(piece: str) -> bytes:
        if len(piece) <= _LONG_PIECE and "<|" not in piece and (piece.isascii() or _COMMON.fullmatch(piece)):
            return b"".join(map(merged, split(lower(piece) if kind == "dropped" else piece)))
        return array("I", tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    # What a word is split into are words too, so that every part is held once.
    if kind == "dropped":

        def word_ids(word: str) -> tuple[bytes, bool]:
            if len(word) <= _LONG_PIECE and (word.isascii() or _COMMON.fullmatch(word)):
                low = lower(word)
                if low.isalpha():
                    if low != word:
                        return words[low], True
                    # Printing ASCII stands for itself.
                    if low.isascii():
                        return array("I", [t.id for t in merges(low)]).tobytes(), True
                    return merged(low), True
                if low[:-1].isalpha() and low[-1].isprintable():
                    return words[low[:-1]] + words[low[-1]], len(low) <= _SHORT_WORD
                if "<|" not in low:
                    found = split(low)
                    if len(found) == 1:
                        return merged(found[0]), True
                    return b"".join([words[part] for part in found]), len(low) <= _SHORT_WORD
            return encode(word), len(word) <= _LONG_PIECE

        words = _Words(word_ids, WORD_CACHE)

        def dropped(text: str) -> bytes:
            return b"".join(map(words.__getitem__, text.replace("\n", " ").split(" ")))

        dropped.word_ids = word_ids
        dropped.parts = lambda text: [text.replace("\n", " ")]
        return dropped

    # A word stands for itself behind a blank; a mark in front says that none is there.
    blank = letters[32]

    def word_ids(word: str) -> tuple[bytes, bool]:
        if len(word) < _LONG_PIECE and (word.isascii() or _COMMON.fullmatch(word)):
            if word.isalpha():
                if word.isascii():
                    return array("I", [t.id for t in merges(blank + word)]).tobytes(), True
                return merged(" " + word), True
            if word[:-1].isalpha():
                return words[word[:-1]] + words[_NO_BLANK + word[-1]], len(word) <= _SHORT_WORD
            if word == "\n":
                return encode(word), True
            piece = word[1:] if word[0] == _NO_BLANK else " " + word
            if "<|" not in piece:
                found = split(piece)
                if len(found) == 1:
                    return merged(piece), True
                ids = [words[part[1:] if part[0] == " " else _NO_BLANK + part] for part in found]
                return b"".join(ids), len(word) <= _SHORT_WORD
        return encode(word[1:] if word[0] == _NO_BLANK else " " + word), len(word) <= _LONG_PIECE

    words = _Words(word_ids, WORD_CACHE)

    def marked(text: str) -> str:
        return (_NO_BLANK + text).replace("\n", f" \n {_NO_BLANK}")

    def parts(text: str) -> list[str | bytes]:
        if not text:
            return []
        if _is_plain(text):
            return [marked(text)]
        return [encode(part) if odd else marked(part) for part, odd in _lines(text)]

    def kept(text: str) -> bytes:
        of = words.__getitem__
        return b"".join([p if isinstance(p, bytes) else b"".join(map(of, p.split(" "))) for p in parts(text)])

    kept.word_ids, kept.parts = word_ids, parts
    return kept


class _Known:
    """Ids of many texts at once.

    Arrow splits the texts, finds the distinct words of all and puts their ids in the places of the words; only words
    that are not known from before are encoded one by one.
    """

    def __init__(self, of: Callable[[str], bytes]):
        self.word_ids, self.parts = of.word_ids, of.parts
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.met, self.turn = np.zeros(0, np.int64), 0

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, as ``tokenizer_ids`` gives them."""
        parts = [self.parts(text) for text in texts]
        lines = [part for some in parts for part in some if isinstance(part, str)]
        words = pc.split_pattern(pa.array(lines, pa.large_string()), " ")
        found = words.values.dictionary_encode()
        ids = self._distinct(found.dictionary).take(found.indices)
        _, places, data = ids.buffers()
        ends = np.frombuffer(places, "<i8", len(ids) + 1, 8 * ids.offset)[words.offsets.to_numpy()].tolist()
        raw = memoryview(data) if data is not None else b""
        of_line = iter([raw[a:b] for a, b in zip(ends, ends[1:], strict=False)])
        return [b"".join([part if isinstance(part, bytes) else next(of_line) for part in some]) for some in parts]

    def _distinct(self, words: pa.Array) -> pa.Array:
        known = len(self.words)
        at = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy().copy()
        lacking = np.flatnonzero(at < 0)
        at[lacking] = known + np.arange(len(lacking))
        new = words.take(pa.array(lacking))
        encoded = pa.array([self.word_ids(word)[0] for word in new.to_pylist()], pa.large_binary())
        ids = pa.concat_arrays([self.ids, encoded])
        self.turn += 1
        met = np.r_[self.met, np.zeros(len(lacking), np.int64)]
        met[at] = self.turn
        keep = np.flatnonzero(np.r_[np.ones(known, bool), pc.utf8_length(new).to_numpy() <= _LONG_PIECE])
        if len(keep) > KNOWN_WORDS:
            keep = np.sort(keep[np.argsort(-met[keep], kind="stable")[: KNOWN_WORDS * 3 // 4]])
        stays = pa.array(keep)
        self.words, self.ids = pa.concat_arrays([self.words, new]).take(stays), ids.take(stays)
        self.met = met[keep]
        return ids.take(pa.array(at))


@lru_cache(maxsize=4)
def _known(name: str) -> _Known:
    return _Known(tokenizer_ids(name))


def encoded_texts(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[pa.Table, list[bytes]]]:
    """Rows and the ids of their column ``text`` (null: none), about ``GROUP_BYTES`` of texts at a time."""
    known, held, texts, size = _known(name), [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch.drop_columns("text"))
        texts += [text or "" for text in batch.column("text").to_pylist()]
        size += batch.column("text").nbytes
        if size >= GROUP_BYTES:
            yield pa.Table.from_batches(held), known(texts)
            held, texts, size = [], [], 0
            pa.default_memory_pool().release_unused()
    if held:
        yield pa.Table.from_batches(held), known(texts)


_NO_BLANK = "\0"
_ODD_SPACE = regex.compile("[\\s\0\x1c-\x1f\x85--[ \n]]", regex.V1)


def _has_odd_space(text: str) -> bool:
    """Of all white space only the blank prints, so that most texts need no search."""
    return not text.replace("\n", "").isprintable() and _ODD_SPACE.search(text) is not None


def _is_plain(text: str) -> bool:
    """Whether no white space but single blanks and single line feeds stands between other characters."""
    ends = text[0] in " \n" or text[-1] in " \n"
    return not (ends or "  " in text or " \n" in text or "\n " in text or "\n\n" in text or _has_odd_space(text))


def _lines(text: str) -> Iterator[tuple[str, bool]]:
    """A text's lines in parts (part, odd).

    An odd part holds a run of lines that are empty or hold other white space than single blanks, with the plain lines
    next to it and the line feeds at its ends, so that it can be encoded by itself.  Other parts are plain.
    """
    lines = text.split("\n")
    plain = [bool(line) and _is_plain(line) for line in lines]
    inner = [
        ok and (i == 0 or plain[i - 1]) and (i + 1 == len(lines) or plain[i + 1]) for i, ok in enumerate(plain)
    ]
    start = 0
    for end in range(1, len(lines) + 1):
        if end < len(lines) and inner[end] == inner[start]:
            continue
        part = "\n".join(lines[start:end])
        if inner[start]:
            yield part, False
            if end < len(lines):
                yield "\n", True
        else:
            yield part + ("\n" if end < len(lines) else ""), True
        start = end


# --- the file format ------------------------------------------------------------------------------------------

#: Ids of a chunk.  A chunk is read and written by itself.
CHUNK_IDS = 1 << 18
FORMAT = "planes 1"
#: Stands for a null id in the files.
NO_ID = np.iinfo(np.int64).min


def shuffle_planes(ids: np.ndarray, planes: str = "byte") -> list[bytes]:
    """A block of 32-bit ids as planes: all lowest bytes (or bits), then all next ones, as far as any is set."""
    ids = np.ascontiguousarray(ids, "<u4")
    if planes == "byte":
        return [plane.tobytes() for plane in ids.view(np.uint8).reshape(-1, 4).T]
    bits = np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return [np.packbits(plane, bitorder="little").tobytes() for plane in bits.T]


def join_planes(parts: list[bytes], n: int, planes: str = "byte") -> np.ndarray:
    """The inverse of ``shuffle_planes``."""
    if planes == "byte":
        raw = np.stack([np.frombuffer(p, np.uint8, n) for p in parts], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in parts], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").ravel()


def pack_chunk(ids: np.ndarray, planes: str = "byte", level: int = 3) -> list[bytes]:
    """Every plane compressed by zstandard; an empty string stands for a plane of zeros."""
    press = zstandard.ZstdCompressor(level=level)
    return [press.compress(p) if p.count(0) < len(p) else b"" for p in shuffle_planes(ids, planes)]


def unpack_chunk(parts: list[bytes], n: int, planes: str = "byte") -> np.ndarray:
    length = n if planes == "byte" else -(-n // 8)
    press = zstandard.ZstdDecompressor()
    whole = [press.decompress(p, max_output_size=length) if p else bytes(length) for p in parts]
    return join_planes(whole, n, planes)


_CHUNK_SCHEMA = (
    "part int, chunk int, doc_ids binary, lengths binary, n_ids long, plane_sizes array<int>, planes array<binary>"
)


def _encode_part(name: str, end_id: int, planes: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[int] = []
        held: list[np.ndarray] = []
        size = chunk = 0
        part = None

        def packed() -> pa.RecordBatch:
            parts = pack_chunk(np.concatenate(held), planes)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([chunk], pa.int32()),
                    pa.array([np.array(docs, "<i8").tobytes()], pa.binary()),
                    pa.array([np.array([len(h) for h in held], "<i8").tobytes()], pa.binary()),
                    pa.array([size], pa.int64()),
                    pa.array([[len(p) for p in parts]], pa.list_(pa.int32())),
                    pa.array([parts], pa.list_(pa.binary())),
                ],
                names=["part", "chunk", "doc_ids", "lengths", "n_ids", "plane_sizes", "planes"],
            )

        end = np.array([end_id], "<u4").tobytes()
        for rows, encoded in encoded_texts(batches, name):
            part = rows.column("part")[0].as_py()
            for doc, of_text in zip(rows.column("doc_id").to_pylist(), encoded, strict=True):
                ids = np.frombuffer(of_text + end, "<u4")
                docs.append(NO_ID if doc is None else doc)
                held.append(ids)
                size += len(ids)
                if size >= CHUNK_IDS:
                    yield packed()
                    docs, held, size, chunk = [], [], 0, chunk + 1
        if held:
            yield packed()

    return encode


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, planes: str = "byte") -> None:
    """Write the ids of every text, followed by ``end_id``, in ascending order of doc_id.

    ``path`` gets two tables: ``chunks``, whose rows hold the compressed planes of about ``CHUNK_IDS`` ids (more only
    where one document is longer), the ids of its documents and their lengths, and ``index``, which places every
    chunk in the whole.  Parts ascend with doc_id and chunks within parts.  Documents are not cut.  Null texts
    are empty, rows without an id come first, and rows of equal id come in the order of their texts' hashes.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = source.repartitionByRange(lanes(spark), F.col("doc_id"), F.xxhash64("text"))
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text")).withColumn("part", F.spark_partition_id())
    chunks = map_batches(ordered, _encode_part(tokenizer, end_id, planes), _CHUNK_SCHEMA)
    chunks.withColumn("format", F.lit(f"{FORMAT} {planes}")).write.parquet(f"{path}/chunks")
    written = spark.read.parquet(f"{path}/chunks").select("part", "chunk", "n_ids", "plane_sizes")
    _with_starts(written).write.parquet(f"{path}/index")


def _with_starts(chunks: DataFrame) -> DataFrame:
    """Add ``start``: the ids of all chunks before.  Sums of parts first, so that no task sees all chunks."""
    from pyspark.sql import Window

    before = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    parts = chunks.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    parts = parts.select("part", F.coalesce(F.sum("_ids").over(before("part")), F.lit(0)).alias("_start"))
    within = F.coalesce(F.sum("n_ids").over(before("part", "chunk")), F.lit(0))
    return chunks.withColumn("_within", within).join(parts, "part").select(
        "part", "chunk", "n_ids", "plane_sizes", (F.col("_start") + F.col("_within")).alias("start")
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids (little-endian 32-bit) for every document of the files."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name, row=row, batch=batch: batch.column(name)[row].as_py()
                ids = unpack_chunk(get("planes"), get("n_ids"), get("format").rsplit(" ", 1)[1]).astype("<u4")
                docs, lengths = np.frombuffer(get("doc_ids"), "<i8"), np.frombuffer(get("lengths"), "<i8")
                ends = np.cumsum(lengths)
                for first in range(0, len(docs), 256):
                    some = slice(first, first + 256)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(docs[some], mask=docs[some] == NO_ID),
                            pa.array(get("start") + ends[some] - lengths[some]),
                            pa.array(
                                [ids[e - n : e].tobytes() for e, n in zip(ends[some], lengths[some], strict=True)],
                                pa.binary(),
                            ),
                        ],
                        names=["doc_id", "start", "ids"],
                    )

    chunks = spark.read.parquet(f"{path}/chunks").join(
        spark.read.parquet(f"{path}/index").select("part", "chunk", "start"), ["part", "chunk"]
    )
    needed = chunks.select("start", "format", "doc_ids", "lengths", "n_ids", "planes")
    return map_batches(needed, decode, "doc_id long, start long, ids binary")

