"""Periodic runs: every stretch of words that repeats with a period, in whole documents of any length.

A run is a stretch of consecutive words with smallest period q, at least ``MIN_LENGTH`` words and ``MIN_TURNS``
periods long, that no neighbouring word extends.  Words q apart are equal on the run's first (length - q)
places, its *stretch*; runs are found as stretches.

Scale-tiled: periods are taken by octave [P, 2P).  In an octave a boundary stands at every 2P words; a
stretch is at least 2P long, so some boundary lies in it.  The tile of a boundary reaches ``reach(P)`` words to
its left and that and 2P words to its right.  The Z-function of the words right of the boundary tells for
each period how far the stretch goes on, the Z-function of the reversed words how far it comes from, both
within the tile.  (Tiles are first looked through all together: one without a pair of equal words that goes on
for 16 words in either direction has no fragment, and its Z-functions are not worked out.)  Each tile is
solved on its own; fragments of one document and period that touch are stitched after a shuffle by
(document, period).  Of stretches that are the same run only the smallest period stays.

A document of up to ``TILE_WORDS`` words is solved where it is read, as one row holding all its tiles.  Longer
ones are exploded into rows of neighbouring tiles, octave by octave, which are dealt over the cluster, so a
giant document is solved by many tasks.  Words are told apart exactly (by dictionary codes, not hashes).

Defined results: a null text has no words; an empty text alike; repeated rows give repeated results; rows
without id are never rewritten; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrowtext import WHITE_SPACE, Chunk, chunks, words
from tidemark.llm.tables import stored

MIN_LENGTH = 24
MIN_TURNS = 3
#: A stretch has MIN_LENGTH - 7 words at least for periods under 8, and twice the period beyond.
MIN_STRETCH = 16
TILE_WORDS = 8192
TEXT_BYTES = 2 << 20
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def reach(octave: int) -> int:
    return max(2 << octave, MIN_STRETCH)


def octaves(n: int) -> int:
    """Octaves of the periods that a run in n words can have."""
    return 0 if n < MIN_LENGTH else (n // MIN_TURNS).bit_length()


def z_function(s: list[int]) -> list[int]:
    """Length of the longest common prefix of s and each of its suffixes (0 at the start)."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        left, right = i, i + k
    return z


@dataclass
class Pieces:
    """Stretches of coded words: piece i is ``codes[first[i]:first[i + 1]]``, begins at word ``at[i]`` of its document,
    and holds the tiles of the octaves ``low[i]`` to ``high[i] - 1`` whose boundary is in ``start[i]:stop[i]``."""

    codes: np.ndarray
    first: np.ndarray
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray
    start: np.ndarray
    stop: np.ndarray


def _candidates(p: Pieces, octave: int) -> Iterator[tuple[int, int]]:
    """(piece, boundary in ``codes``) of the tiles that may hold a fragment of a period of this octave."""
    period = 1 << octave
    hop = 2 * period
    use = np.flatnonzero((p.low <= octave) & (octave < p.high))
    if not len(use):
        return
    low = -(-p.start[use] // hop)  # numbers of the boundaries
    count = np.maximum(-(-p.stop[use] // hop) - low, 0)
    piece = np.repeat(use, count)
    if not len(piece):
        return
    number = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    boundary = number * hop - p.at[piece] + p.first[piece]
    codes, n = p.codes, len(p.codes)
    shifts = np.arange(period, hop)
    for lo in range(0, len(piece), max(1, (1 << 19) // period)):
        b, of = boundary[lo:lo + max(1, (1 << 19) // period)], piece[lo:lo + max(1, (1 << 19) // period)]
        i, j = np.nonzero(codes[np.minimum(b[:, None] + shifts, n - 1)] == codes[b][:, None])
        at, q = b[i], shifts[j]
        inside = at + q < p.first[of[i] + 1]
        i, at, q = i[inside], at[inside], q[inside]
        begin, end = p.first[of[i]], p.first[of[i] + 1]
        length = np.ones(len(i), dtype=np.int64)
        for step in (1, -1):  # on to the right, then to the left
            going, t = np.arange(len(i)), step
            while len(going) and abs(t) < MIN_STRETCH:
                x, y = at[going] + t, at[going] + q[going] + t
                ok = (x >= begin[going]) & (y < end[going])
                ok &= codes[np.maximum(x, 0)] == codes[np.minimum(y, n - 1)]
                going = going[ok]
                length[going] += 1
                t += step
        for k in np.unique(i[length >= MIN_STRETCH]):
            yield int(of[k]), int(b[k])


def _tile(codes: np.ndarray, begin: int, end: int, b: int, octave: int) -> Iterator[tuple[int, int, int]]:
    """(period, from, to) of the stretches through boundary b, as far as its tile reaches; places in ``codes``."""
    period, far = 1 << octave, reach(octave)
    lo, hi, mid = max(begin, b - far), min(end, b + far + 2 * period), min(end, b + 2 * period)
    onward = z_function(codes[b:hi].tolist())
    left = codes[lo:b][::-1].tolist()
    backward = z_function([*left, -1, *codes[lo:mid][::-1].tolist()])
    for q in range(period, min(2 * period, len(onward))):
        right = min(onward[q], far)
        come = backward[len(left) + 1 + mid - b - q] if left else 0
        if right and right + come >= MIN_STRETCH:
            yield q, b - come, b + right


def fragments(p: Pieces) -> list[list[tuple[int, int, int]]]:
    """Per piece its (period, from, to) stretches, those that touch made one; places in the document."""
    found: list[dict[int, list[list[int]]]] = [{} for _ in range(len(p.at))]
    for octave in range(int(p.high.max(initial=0))):
        for piece, b in _candidates(p, octave):
            begin, shift = int(p.first[piece]), int(p.at[piece]) - int(p.first[piece])
            for q, x, y in _tile(p.codes, begin, int(p.first[piece + 1]), b, octave):
                have = found[piece].setdefault(q, [])
                if have and x + shift <= have[-1][1]:  # boundaries come in ascending order
                    have[-1][0] = min(have[-1][0], x + shift)
                    have[-1][1] = max(have[-1][1], y + shift)
                else:
                    have.append([x + shift, y + shift])
    return [[(q, x, y) for q, spans in sorted(f.items()) for x, y in spans] for f in found]


def tiles(n: int, tile_words: int = TILE_WORDS) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Tile rows of a long document: (first word, end word, low octave, high octave, start, stop).  Octaves whose tiles
    are small beside a row share rows; beyond, a row has the tiles of four boundaries of one octave."""
    top = octaves(n)
    shared = min((tile_words // 16).bit_length(), top)
    groups = [(0, shared, tile_words)] * (shared > 0) + [(k, k + 1, 8 << k) for k in range(shared, top)]
    for low, high, core in groups:
        far, longest = reach(high - 1), 1 << (high - 1)
        for start in range(0, n, core):
            stop = min(start + core, n)
            yield max(0, start - far), min(n, stop + far + 2 * longest), low, high, start, stop


def _joined(letters: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the chosen words with one space after each, and where each begins."""
    lengths = (offsets[1:] - offsets[:-1])[index]
    begin = np.concatenate(([0], np.cumsum(lengths + 1)))
    out = np.full(begin[-1], 32, dtype=np.uint8)
    before = np.cumsum(lengths) - lengths
    step = np.arange(int(lengths.sum()))
    out[np.repeat(begin[:-1] - before, lengths) + step] = letters[np.repeat(offsets[index] - before, lengths) + step]
    return out, begin


def _letters(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' bytes on end, their offsets, and the first word of each text."""
    spans = words(chunk, WHITE_SPACE)
    letters = chunk.data[~WHITE_SPACE[chunk.data]]
    return letters, np.concatenate(([0], np.cumsum(spans.ends - spans.starts))), np.asarray(spans.first)


def _codes(letters: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words."""
    n = len(offsets) - 1
    if not n:
        return np.zeros(0, dtype=np.int32)
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(letters)])
    return column.dictionary_encode().indices.to_numpy().astype(np.int32)


Rewrite = Callable[[int, int], "np.ndarray | None"]


def planted_tail(doc_id: int, n: int) -> np.ndarray | None:
    """Places of the words that the contract's rule puts into a document of n words: the tail of every tenth
    becomes periodic."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate((np.arange(a), a + np.arange(n - a) % p))


_FRAGMENTS = pa.list_(pa.struct([("period", pa.int64()), ("x", pa.int64()), ("y", pa.int64())]))
_TILE = pa.struct([("at", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()),
                   ("codes", pa.binary())])
_READ = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("sha", pa.string()), ("body", pa.binary()),
                   ("found", _FRAGMENTS), ("tile", _TILE)])
_READ_DDL = ("key long, doc_id long, n long, sha string, body binary, found array<struct<period:long,x:long,y:long>>, "
             "tile struct<at:long,low:int,high:int,start:long,stop:long,codes:binary>")


def _read(batches, rewrite: Rewrite | None, keep_all: bool, tile_words: int):
    """Documents to rows: one each with its fragments, or for long ones their unsolved tiles as well."""
    for batch in batches:
        keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for chunk in chunks(batch.column(2), lower=False, limit=TEXT_BYTES):
            letters, offsets, first = _letters(chunk)
            index = np.arange(len(offsets) - 1)
            counts = np.diff(first)
            for i in range(len(chunk)):
                doc_id = ids[chunk.first + i]
                places = rewrite(doc_id, int(counts[i])) if rewrite and doc_id is not None else None
                if places is not None:
                    index[first[i]:first[i + 1]] = first[i] + places
            codes = _codes(letters, offsets)[index]
            text, begin = _joined(letters, offsets, index)
            zero = np.zeros(len(counts), dtype=np.int64)
            short = counts <= tile_words
            high = np.array([octaves(int(n)) if s else 0 for n, s in zip(counts, short, strict=True)], dtype=np.int64)
            found = fragments(Pieces(codes, first, zero, zero, high, zero, counts))
            rows = []
            for i, n in enumerate(counts.tolist()):
                body = text[begin[first[i]]:begin[first[i + 1]] - 1].tobytes() if n else b""
                key, doc_id = keys[chunk.first + i], ids[chunk.first + i]
                kept = body if keep_all or found[i] or not short[i] else None
                rows.append({"key": key, "doc_id": doc_id, "n": n, "sha": hashlib.sha256(body).hexdigest(), "body": kept,
                             "found": [{"period": q, "x": x, "y": y} for q, x, y in found[i]], "tile": None})
                if not short[i]:
                    own = codes[first[i]:first[i + 1]]
                    for at, end, lo, hi, start, stop in tiles(n, tile_words):
                        rows.append({"key": key, "tile": {"at": at, "low": lo, "high": hi, "start": start, "stop": stop,
                                                          "codes": own[at:end].astype("<i4").tobytes()}})
            yield pa.RecordBatch.from_pylist(rows, schema=_READ)


_SPAN = pa.schema([("key", pa.int64()), ("period", pa.int64()), ("x", pa.int64()), ("y", pa.int64())])


def _solve(batches):
    """Tile rows of long documents to fragments."""
    for batch in batches:
        for row in range(batch.num_rows):
            key, tile = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
            codes = np.frombuffer(tile["codes"], dtype="<i4")
            one = {c: np.array([tile[c]], dtype=np.int64) for c in ("at", "low", "high", "start", "stop")}
            (found,) = fragments(Pieces(codes, np.array([0, len(codes)]), **one))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(found)), *[pa.array(c, pa.int64()) for c in zip(*found, strict=True)]],
                                                 schema=_SPAN)


def stitched(spans: DataFrame) -> DataFrame:
    """Fragments (key, period, x, y) to runs (key, start, length, period)."""
    inside = Window.partitionBy("key", "period").orderBy("x", "y")
    before = F.max("y").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    fresh = spans.withColumn("fresh", (before.isNull() | (F.col("x") > before)).cast("int"))
    whole = fresh.withColumn("part", F.sum("fresh").over(inside)).groupBy("key", "period", "part") \
        .agg(F.min("x").alias("start"), (F.max("y") - F.min("x") + F.col("period")).alias("length"))
    long = whole.where(F.col("length") >= F.greatest(F.lit(MIN_LENGTH), MIN_TURNS * F.col("period")))
    return long.groupBy("key", "start", "length").agg(F.min("period").alias("period"))


_RUN = "struct<start:long,length:long,period:long>"


def _collapse(batches, texts: bool):
    """Rows with their runs: what is left without the words that runs repeat."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            raw = np.frombuffer(row["body"], dtype=np.uint8)
            letters, offsets, _ = _letters(Chunk(0, raw, np.array([0, len(raw)]), np.ones(1, bool)))
            mark = np.zeros(row["n"] + 1, dtype=np.int64)
            for run in row["runs"]:
                mark[run["start"] + run["period"]] += 1
                mark[run["start"] + run["length"]] -= 1
            text, _ = _joined(letters, offsets, np.flatnonzero(np.cumsum(mark)[:-1] == 0))
            left = text[:-1].tobytes()
            rows.append({"doc_id": row["doc_id"], "n_words": row["n"], "runs": row["runs"],
                         "collapsed": left.decode() if texts else hashlib.sha256(left).hexdigest()})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                ("doc_id", pa.int64()), ("n_words", pa.int64()),
                ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                ("collapsed", pa.string())]))


def periodic_runs(documents: DataFrame, rewrite: Rewrite | None = None, texts: bool = True,
                  tile_words: int = TILE_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, runs (start, length, period; by start, then period) and ``collapsed``: the text
    without the words that a run repeats, joined by single spaces (``texts=False``: its SHA-256 in hex).

    ``rewrite`` (doc_id, words) may give other places to take the words from, as a test plants runs."""
    rows = documents.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    read = stored(rows.mapInArrow(lambda batches: _read(batches, rewrite, texts, tile_words), _READ_DDL))
    docs, long = read.where("tile IS NULL").drop("tile"), read.where("tile IS NOT NULL").select("key", "tile")
    solved = long.repartition("key", "tile.low", "tile.start").mapInArrow(_solve, "key long, period long, x long, y long")
    spans = docs.select("key", F.explode("found").alias("f")).select("key", "f.*").unionByName(solved)
    # a document has fewer runs than words, so its list is bounded by its text
    runs = stitched(spans).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    ordered = F.transform("runs", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period")))
    none = F.expr(f"CAST(array() AS array<{_RUN}>)")
    open_ = (F.size("found") > 0) | (F.col("n") > tile_words)
    whole = F.col("body").cast("string") if texts else F.col("sha")
    plain = docs.where(~open_).select("doc_id", F.col("n").alias("n_words"), none.alias("runs"), whole.alias("collapsed"))
    rest = docs.where(open_).select("key", "doc_id", "n", "body").join(runs.select("key", ordered.alias("runs")), "key", "left") \
        .select("doc_id", "n", "body", F.coalesce("runs", none).alias("runs"))
    return plain.unionByName(rest.mapInArrow(lambda batches: _collapse(batches, texts),
                                             f"doc_id long, n_words long, runs array<{_RUN}>, collapsed string"))


def report(found: DataFrame) -> DataFrame:
    """Digest of ``periodic_runs(texts=False)``: the number of runs, the one with the greatest length by period (ties:
    smallest start, then period), and checksums of all runs and of what is left."""
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, r: F.when(
        r["length"] * a["period"] > a["length"] * r["period"], r).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listing = F.concat_ws("", F.transform(lines, lambda line: F.concat(line, F.lit("\n"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(listing.cast("binary"), 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"))
