"""Collocations of two to five words by language, from Rabin-Karp fingerprints.

1. Words are hashed, and prefix sums of a polynomial over the word hashes give the fingerprint of every n-gram of a
   piece by one subtraction.  There are two, of independent hashes: the key and a check.
2. Pass n counts the n-grams whose two (n-1)-grams may be frequent by a bitmap of fixed size.  Tasks merge equal
   fingerprints before the shuffle, each with an occurrence pointer, ``POINTER_BITS`` of the hash of a text that holds
   the n-gram.  The shuffle sums the counts and keeps the least pointer.
3. Only n-grams counted often enough are turned into text: the texts pointed to are read again, key and check are
   computed from their words once more, and every fingerprint must be found and stand for one phrase.  Pointers that
   several texts share lead to all of them.
4. Counts of first parts, rests and longer phrases are looked up by fingerprint, with hot parts dealt out.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.lookup import spread_lookup
from ..session import stage_table
from .common import column_numpy, lanes, map_batches, mix64

LONGEST = 5
LEAST = 100
TOP = 2000
UNKNOWN = "und"
#: Bits of the map of frequent fingerprints, whatever their number.  A full map prunes less and loses nothing.
MAP_BITS = 1 << 26
#: Bits of an occurrence pointer.  Fewer make shuffled rows shorter, and more texts share a pointer and are read again.
POINTER_BITS = 40
BLOCK_BYTES = 4 << 20
HELD_GRAMS = 1 << 21
HOT_USES = 1000

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_SEEDS = (_U(0x243F6A8885A308D3), _U(0x13198A2E03707344))
_MOD = 1 << 64

_WORD, _BLANK, _BREAK = 0, 1, 2
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = _BLANK
_CLASS[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, as far as they have been needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, _MOD)
        self.up = self.down = np.ones(1, _U)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * _U(pow(self.base, k, _MOD))])
            self.down = np.concatenate([self.down, self.down * _U(pow(self.inverse, k, _MOD))])
        return self.up[:n], self.down[:n]


class Words:
    """The words of a block of texts: places, pieces, texts, and the prefix polynomials of their hashes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, powers: tuple[_Powers, _Powers]):
        """``data`` holds the texts one behind the other, ``starts`` where each begins."""
        self.data = _LOWER[data]
        kind = _CLASS[self.data]
        inside = kind == _WORD
        new = inside.copy()
        new[1:] &= ~inside[:-1]
        # A text that begins inside a run of word bytes begins a word.
        first = starts[starts < len(data)]
        new[first] |= inside[first]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | new[1:]
        self.starts, self.ends = np.flatnonzero(new), np.flatnonzero(last) + 1
        self.text = np.searchsorted(starts, self.starts, "right") - 1
        breaks = np.cumsum(kind == _BREAK, dtype=np.int64)[self.starts]
        n = len(self.starts)
        apart = np.ones(n, bool)
        apart[1:] = (breaks[1:] != breaks[:-1]) | (self.text[1:] != self.text[:-1])
        self.piece = np.cumsum(apart)
        hashes = self._hashes()
        self.sums = []
        self.down = []
        for value, power in zip(hashes, powers, strict=True):
            up, down = power.of(n + 1)
            total = np.zeros(n + 1, _U)
            np.cumsum(value * up[:n], out=total[1:])
            self.sums.append(total)
            self.down.append(down)

    def __len__(self) -> int:
        return len(self.starts)

    def _hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of every word, eight bytes at a time."""
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.data) + 1,), "<u8", padded.data, strides=(1,))
        at, left = self.starts.copy(), self.ends - self.starts
        one, two = left.astype(_U) * _STEP, mix64(left.astype(_U) + _SEEDS[1])
        open_ = np.arange(len(at))
        while len(open_):
            size = np.minimum(left[open_], 8).astype(_U)
            value = eight[at[open_]] & (_U(0xFFFFFFFFFFFFFFFF) >> ((_U(8) - size) * _U(8)))
            one[open_] = mix64((one[open_] ^ value) * _STEP + _SEEDS[0])
            two[open_] = mix64((two[open_] + value) * _U(_BASES[1])) ^ value
            left[open_] -= 8
            at[open_] += 8
            open_ = open_[left[open_] > 0]
        return mix64(one), mix64(two + _SEEDS[0])

    def grams(self, n: int) -> np.ndarray:
        """The words at which an n-gram of one piece begins."""
        if len(self) < n:
            return np.empty(0, np.int64)
        return np.flatnonzero(self.piece[: len(self) - n + 1] == self.piece[n - 1 :])

    def fingerprints(self, at: np.ndarray, n: int, langs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key, check) of the n-grams at these words; ``langs`` holds a hash of each text's language."""
        tag = langs[self.text[at]] + _U(n) * _STEP
        out = []
        for total, down, seed in zip(self.sums, self.down, _SEEDS, strict=True):
            polynomial = (total[at + n] - total[at]) * down[at]
            out.append(mix64(polynomial ^ mix64(tag ^ seed)))
        return out[0], out[1]

    def phrase(self, at: int, n: int) -> str:
        words = [self.data[self.starts[i] : self.ends[i]].tobytes() for i in range(at, at + n)]
        return b" ".join(words).decode(errors="replace")


def blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, starts, rows): the texts of a batch in blocks; a long text is cut behind the end of a piece."""
    held: list[bytes] = []
    rows: list[int] = []
    size = 0

    def block():
        starts = np.cumsum([0, *map(len, held[:-1])], dtype=np.int64)
        return np.frombuffer(b"".join(held), np.uint8), starts, np.array(rows, np.int64)

    for row, text in enumerate(batch.column("body")):
        whole = text.as_py() or b""
        at = 0
        while at < len(whole):
            end = min(at + BLOCK_BYTES, len(whole))
            if end < len(whole):
                cut = np.flatnonzero(_CLASS[np.frombuffer(whole, np.uint8, end - at, at)] == _BREAK)
                if len(cut):
                    end = at + int(cut[-1]) + 1
                else:
                    more = np.flatnonzero(_CLASS[np.frombuffer(whole, np.uint8, -1, end)] == _BREAK)
                    end = end + int(more[0]) + 1 if len(more) else len(whole)
            held.append(whole[at:end])
            rows.append(row)
            size += end - at
            at = end
            if size >= BLOCK_BYTES:
                yield block()
                held, rows, size = [], [], 0
    if held:
        yield block()


def _summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """(key, check, count, text) with equal (key, check) merged; of their texts the least is kept."""
    key, check, count, text = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(key, kind="stable")
    key, check, count, text = key[order], check[order], count[order], text[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    if (check[1:] != check[:-1])[~new[1:]].any():  # one key, several checks
        order = np.lexsort((check, key))
        key, check, count, text = key[order], check[order], count[order], text[order]
        new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
    first = np.flatnonzero(new)
    if not len(first):
        return key, check, count, text
    return key[first], check[first], np.add.reduceat(count, first), np.minimum.reduceat(text, first)


def _known(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    place = key & _U(len(bits) * 64 - 1)
    return (bits[(place >> _U(6)).astype(np.int64)] >> (place & _U(63))) & _U(1) == _U(1)


_COUNTS = "key bigint, chk bigint, count bigint, text_key bigint"


def _count_grams(n: int, bits: np.ndarray | None, key_mask: int):
    """Batches of (lang_hash, text_key, body) -> counted fingerprints of the n-grams, merged as far as memory allows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = tuple(_Powers(b) for b in _BASES)
        parts: list[tuple[np.ndarray, ...]] = []
        rows, merged = 0, 0

        def batch_of(table: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
            names = [c.split()[0] for c in _COUNTS.split(", ")]
            arrays = [pa.array(a.view(np.int64)) for a in table]
            whole = pa.RecordBatch.from_arrays(arrays, names=names)
            for start in range(0, whole.num_rows, 65_536):
                yield whole.slice(start, 65_536)

        with np.errstate(over="ignore"):
            for batch in batches:
                langs = column_numpy(batch, "lang_hash").view(_U)
                texts = column_numpy(batch, "text_key")
                for data, starts, row in blocks(batch):
                    words = Words(data, starts, powers)
                    at = words.grams(n)
                    if n > 1 and len(at):
                        both, _ = words.fingerprints(np.append(at, at[-1] + 1), n - 1, langs[row])
                        near = _known(bits, both[:-1] & _U(key_mask))
                        # The second part begins one word on, where mostly the next n-gram begins as well.
                        rest, _ = words.fingerprints(at[near] + 1, n - 1, langs[row])
                        at = at[near][_known(bits, rest & _U(key_mask))]
                    key, check = words.fingerprints(at, n, langs[row])
                    where = texts[row[words.text[at]]]
                    parts.append((key & _U(key_mask), check, np.ones(len(at), np.int64), where))
                    rows += len(at)
                    if rows - merged >= HELD_GRAMS:
                        parts = [_summed(parts)]
                        rows = merged = len(parts[0][0])
                        if merged > HELD_GRAMS // 2:
                            yield from batch_of(parts[0])
                            parts, rows, merged = [], 0, 0
            if rows:
                yield from batch_of(_summed(parts))

    return count


def _bitmap(keys: DataFrame) -> np.ndarray:
    """A map of ``MAP_BITS`` bits with the bits of all keys set; its size does not follow their number."""
    place = F.col("key").bitwiseAND(F.lit(MAP_BITS - 1))
    words = keys.groupBy(F.shiftright(place, 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast((key & {MAP_BITS - 1}) & 63 as int))")).alias("mask")
    )
    filled = words.toPandas()
    bits = np.zeros(MAP_BITS // 64, np.int64)
    bits[filled["word"].to_numpy()] = filled["mask"].to_numpy()
    return bits.view(_U)


_PHRASES = (
    "key bigint, chk bigint, lang string, n int, phrase string, "
    "parts array<struct<key: bigint, chk: bigint>>"
)


def _materialise(longest: int, key_mask: int):
    """Batches of (lang, lang_hash, body, wanted) -> the wanted fingerprints as words.

    ``wanted`` lists the (key, check) to be found in a text; ``parts`` of a phrase holds its first parts and rests by
    the number of words of the first part.
    """
    part = pa.list_(pa.struct([("key", pa.int64()), ("chk", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = tuple(_Powers(b) for b in _BASES)
        with np.errstate(over="ignore"):
            for batch in batches:
                langs = column_numpy(batch, "lang_hash").view(_U)
                names = batch.column("lang").to_pylist()
                wanted = [{(w["key"], w["chk"]) for w in v} for v in batch.column("wanted").to_pylist()]
                out: list[tuple] = []
                for data, starts, row in blocks(batch):
                    words = Words(data, starts, powers)
                    asked = np.array(sorted({k for r in set(row.tolist()) for k, _ in wanted[r]}), np.int64)
                    for n in range(1, longest + 1):
                        at = words.grams(n)
                        key, check = words.fingerprints(at, n, langs[row])
                        key = (key & _U(key_mask)).view(np.int64)
                        check = check.view(np.int64)
                        hit = np.flatnonzero(np.isin(key, asked))
                        _, once = np.unique(np.stack([key[hit], check[hit], row[words.text[at[hit]]]]), axis=1, return_index=True)
                        for i in hit[once].tolist():
                            r = int(row[words.text[at[i]]])
                            if (int(key[i]), int(check[i])) not in wanted[r]:
                                continue
                            parts = []
                            for k in range(1, n):
                                for start, size in ((at[i], k), (at[i] + k, n - k)):
                                    a, b = words.fingerprints(np.array([start]), size, langs[row])
                                    both = ((a & _U(key_mask)).view(np.int64), b.view(np.int64))
                                    parts.append({"key": int(both[0][0]), "chk": int(both[1][0])})
                            out.append((int(key[i]), int(check[i]), names[r], n, words.phrase(int(at[i]), n), parts))
                if out:
                    columns = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(columns[0], pa.int64()),
                            pa.array(columns[1], pa.int64()),
                            pa.array(columns[2], pa.string()),
                            pa.array(columns[3], pa.int32()),
                            pa.array(columns[4], pa.string()),
                            pa.array(columns[5], part),
                        ],
                        names=["key", "chk", "lang", "n", "phrase", "parts"],
                    )

    return find


def _gram(key: str = "key", chk: str = "chk") -> Column:
    """Key and check as one value to be joined by."""
    return F.concat_ws(":", F.hex(key), F.hex(chk))


def frequent_phrases(
    documents: DataFrame, least: int = LEAST, longest: int = LONGEST, key_bits: int = 64
) -> DataFrame:
    """(lang, n, phrase, count, gram, parts) of all n-grams of 1 to ``longest`` words found ``least`` times or more.

    A written table.  ``key_bits`` cuts the keys short, for tests of what then collides.
    """
    mask = (1 << key_bits) - 1
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    texts = documents.select(lang.alias("lang"), F.col("text").cast("binary").alias("body")).filter("body IS NOT NULL")
    pointer = F.xxhash64("lang", "body").bitwiseAND(F.lit((1 << POINTER_BITS) - 1))
    texts = texts.withColumns({"lang_hash": F.xxhash64("lang"), "text_key": pointer})
    read = texts.select("lang_hash", "text_key", "body")
    found, bits = None, None
    for n in range(1, longest + 1):
        counted = map_batches(read, _count_grams(n, bits, mask), _COUNTS)
        often = counted.groupBy("key", "chk").agg(
            F.sum("count").alias("count"), F.min("text_key").alias("text_key")
        )
        level = stage_table(often.filter(F.col("count") >= least), f"grams-{n}")
        found = level if found is None else found.unionByName(level)
        if n < longest:
            bits = _bitmap(level.select("key"))

    gram = F.struct("key", "chk")
    pointers = found.select("text_key", gram.alias("gram"))
    wanted = stage_table(pointers.groupBy("text_key").agg(F.collect_list("gram").alias("wanted")), "pointers")
    pointed = _bitmap(wanted.select(F.col("text_key").alias("key")))

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_known(pointed, column_numpy(batch, "text_key").view(_U))))

    # One of equal texts is read again.
    again = map_batches(texts, maybe, "lang string, body binary, lang_hash bigint, text_key bigint").distinct()
    asked = again.join(wanted, "text_key").select("lang", "lang_hash", "body", "wanted")
    said = map_batches(asked, _materialise(longest, mask), _PHRASES)
    said = said.groupBy("key", "chk").agg(
        F.min("lang").alias("lang"),
        F.min("n").alias("n"),
        F.min("phrase").alias("phrase"),
        (F.max("phrase") != F.min("phrase")).alias("_differ"),
        F.first("parts").alias("parts"),
    )
    trouble = F.when(F.col("phrase").isNull(), "a frequent fingerprint is not in its text").when(
        F.col("_differ"), "two phrases share both fingerprints"
    )
    verified = found.join(said, ["key", "chk"], "left").withColumn(
        "phrase", F.when(trouble.isNotNull(), F.raise_error(trouble).cast("string")).otherwise(F.col("phrase"))
    )
    parts = F.transform("parts", lambda p: F.concat_ws(":", F.hex(p["key"]), F.hex(p["chk"])))
    return stage_table(
        verified.select("lang", "n", "phrase", "count", _gram().alias("gram"), parts.alias("parts")), "phrases"
    )


def collocations(
    documents: DataFrame,
    least: int = LEAST,
    top: int = TOP,
    longest: int = LONGEST,
    cover_percent: int = 100,
    key_bits: int = 64,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every language.

    Texts are lowered (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and pieces into words at blanks and tabs.
    a counts all occurrences of a phrase of 2 to ``longest`` words within pieces, l and r those of its two parts, n all
    words of the language.  The score of a cut is floor(1000 * a * n / (l * r)); of all cuts the lowest score
    counts, of equal ones the shortest first part.  Phrases with ``least`` occurrences are candidates; one inside a longer
    candidate with at least ``cover_percent`` of its occurrences is left out.  Order: score and a descending, phrase.

    ``documents`` has text and lang; no other column is read.  A null text is empty, an empty text has no words, a
    null language is ``und``.  Equal texts and rows all count.  An empty table gives an empty one.  Long texts are read
    in blocks cut between pieces; only a single piece is ever held whole.  Texts that are not valid UTF-8 are
    shown with replacement characters.
    """
    if longest < 2:
        raise ValueError("phrases have two words or more")
    frequent = frequent_phrases(documents, least, longest, key_bits)
    candidates = frequent.filter("n >= 2")

    # An n-gram covered by any longer candidate is covered by one that is longer by one word: counts only fall.
    inner = candidates.filter("n >= 3").select(
        F.explode(F.array(F.element_at("parts", -2), F.element_at("parts", 2))).alias("gram"), "count"
    )
    covers = inner.groupBy("gram").agg(F.max("count").alias("cover"))
    left = candidates.join(covers, "gram", "left").filter(
        F.col("cover").isNull() | (100 * F.col("cover") < cover_percent * F.col("count"))
    )

    single = left.select("gram", F.posexplode("parts").alias("place", "part"))
    uses = single.groupBy(F.col("part").alias("gram")).agg(F.count(F.lit(1)).alias("uses"))
    counts = frequent.select("gram", F.col("count").alias("times")).join(uses, "gram")
    counts = counts.withColumnRenamed("gram", "part")
    row = single.withColumn("row", F.xxhash64("gram", "place"))
    looked = spread_lookup(row, counts, "part", "row", "uses", HOT_USES)
    first = F.floor(F.col("place") / 2).cast("int") + 1
    side = F.when(F.col("place") % 2 == 0, "l").otherwise("r")
    cuts = looked.groupBy("gram", first.alias("k")).agg(
        F.max(F.when(side == "l", F.col("times"))).alias("l"), F.max(F.when(side == "r", F.col("times"))).alias("r")
    )
    return _ranked(documents, left, cuts, top)


def word_totals(documents: DataFrame) -> DataFrame:
    """(lang, n): all words of every language, counted in the JVM."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D.,;:!?]+"))
    return documents.groupBy(lang.alias("lang")).agg(F.sum(words.cast("bigint")).alias("words"))


def _ranked(documents: DataFrame, phrases: DataFrame, cuts: DataFrame, top: int) -> DataFrame:
    def exact(name: str) -> Column:
        return F.col(name).cast("decimal(19,0)")

    # Eight rows or as many as there are languages; the optimizer knows their size only after counting.
    totals = stage_table(word_totals(documents), "word-totals")
    scored = cuts.join(phrases.select("gram", "lang", "phrase", F.col("count").alias("a")), "gram").join(totals, "lang")
    scored = scored.withColumns({"_a": exact("a"), "_n": exact("words"), "_l": exact("l"), "_r": exact("r")})
    scored = scored.withColumn("score", F.expr("(_a * _n * cast(1000 as decimal(4,0))) div (_l * _r)"))
    best = scored.groupBy("gram").agg(
        F.min(F.struct("score", "k", "l", "r", "lang", "phrase", "a", "words")).alias("b")
    )
    rows = best.select("b.*").withColumnRenamed("words", "n")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    lane = F.pmod(F.xxhash64("phrase"), F.lit(lanes(documents.sparkSession)))
    near = Window.partitionBy("lang", "_lane").orderBy(*order)
    rows = rows.withColumn("_lane", lane).withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= top)
    # A second round in fewer lanes, so that the last one sees the square root of the lanes times the top at most.
    rows = rows.withColumn("_lane", F.col("_lane") % isqrt(lanes(documents.sparkSession)))
    rows = rows.withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= top)
    by_lang = Window.partitionBy("lang").orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(by_lang).cast("bigint")).filter(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
