"""Document fingerprints: improbable byte windows in chained Bloom filters, compared by normalised bit overlap.

Every window of ``WINDOW`` bytes of a text has an entropy (of its byte counts, in steps of 1/``STEPS`` bit over
the window).  How many windows of the whole corpus have each entropy is counted once; the rarer the entropy, the
better the window ranks.  Windows of less than ``MIN_ENTROPY`` bits (rulers, blanks) do not count.  In every
neighbourhood of ``NEIGHBOURS`` windows the best one wins (the leftmost of equals); a window that wins
``POPULAR`` neighbourhoods is a feature.  Texts of fewer than ``SHORT`` code points have few windows: all windows of
``SHORT_WINDOW`` bytes are features (the whole text if shorter).  A text without any feature, but not empty, has
its whole bytes as the only one.

Different features, in order, set ``HASHES`` bits each in a Bloom filter of ``BITS`` bits; after ``FEATURES`` features
the next filter of the chain begins.  The fingerprint is ``window-features-filters`` with the filters in base64.

Two filters are compared by their common bits above those expected by chance, over the most that there could
be; two chains by the mean, over the filters of the shorter chain and weighted by their bits, of the best match
in the other.  Equal texts have likeness 1, and so have two empty texts; an empty and another text, and texts
of different window sizes, have 0.

Neighbouring documents meet by one range partitioning by doc_id; the last document of a partition and the
first of the next one are joined through the written results.

Defined results: a null text is empty; rows without id come first; rows of one id are ordered by their text's
hash; the document after the last is the first, which is itself if there is one only; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrowtext import U64, chunks, mix
from tidemark.llm.tables import stored

WINDOW = 16
STEPS = 16
MIN_ENTROPY = 2.0
NEIGHBOURS = 32
POPULAR = 8
SHORT = 96
SHORT_WINDOW = 4
BITS = 2048
HASHES = 5
FEATURES = 160
BLOCK = 1 << 19
TEXT_BYTES = 1 << 20
TEXT_ROWS = 512

#: c * log2(c) in steps: a window's entropy is log2(WINDOW) - sum of these over its byte counts / WINDOW.
SUM_OF = np.array([0] + [round(c * float(np.log2(c)) * STEPS) for c in range(1, WINDOW + 1)], dtype=np.int32)
CLASSES = int(SUM_OF[WINDOW]) + 1
MAX_SUM = int(WINDOW * (np.log2(WINDOW) - MIN_ENTROPY) * STEPS)
UNRANKED = CLASSES


def entropy_sums(data: np.ndarray) -> np.ndarray:
    """For every window of the bytes the sum of SUM_OF over its byte counts, by sliding: what the byte that
    leaves and the byte that enters change, from how often each is in the window besides."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int32)
    before, after = np.zeros(len(data), dtype=np.uint8), np.zeros(len(data), dtype=np.uint8)
    for d in range(1, WINDOW):
        same = data[d:] == data[:-d]
        before[d:] += same
        after[:-d] += same
    step = np.diff(SUM_OF)
    out = np.empty(n, dtype=np.int32)
    out[0] = SUM_OF[np.bincount(data[:WINDOW])].sum()
    out[1:] = step[before[WINDOW:]]
    out[1:] -= step[after[:n - 1]]
    return np.cumsum(out, out=out)


def histogram(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Windows by class, of the texts ``data[first[i]:end[i]]`` that lie on end."""
    out = np.zeros(CLASSES, dtype=np.int64)
    for lo in range(0, len(data), BLOCK):
        sums = entropy_sums(data[lo:lo + BLOCK + WINDOW - 1])
        out += np.bincount(sums, weights=_inside(first, end, lo, len(sums)), minlength=CLASSES).astype(np.int64)
    return out


def _inside(first: np.ndarray, end: np.ndarray, lo: int, n: int) -> np.ndarray:
    """Of the windows lo to lo + n, those that lie in one of the texts."""
    edge = np.zeros(n + 1, dtype=np.int32)
    fits = end - WINDOW + 1 > first
    np.add.at(edge, np.clip(first[fits] - lo, 0, n), 1)
    np.add.at(edge, np.clip(end[fits] - WINDOW + 1 - lo, 0, n), -1)
    return np.cumsum(edge[:-1]) > 0


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Rank of each class, the rarest in the corpus first; classes of too little entropy have none."""
    out = np.empty(CLASSES, dtype=np.int64)
    out[np.lexsort((np.arange(CLASSES), counts))] = np.arange(CLASSES)
    out[MAX_SUM + 1:] = UNRANKED
    return out


def popular(data: np.ndarray, first: np.ndarray, end: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Places of the features of the texts ``data[first[i]:end[i]]`` (each of NEIGHBOURS windows at least)."""
    last = end - WINDOW - NEIGHBOURS + 2  # the neighbourhoods of a text begin before this window
    found = []
    for lo in range(0, len(data), BLOCK):
        left = max(0, lo - NEIGHBOURS + 1)
        sums = entropy_sums(data[left:lo + BLOCK + NEIGHBOURS + WINDOW - 2])
        n = len(sums)
        if n < NEIGHBOURS:
            continue
        key = (ranks[sums] << 32) | np.arange(n)
        reach = 1
        while reach < NEIGHBOURS:
            key = np.minimum(key[:-reach], key[reach:])
            reach *= 2
        edge = np.zeros(len(key) + 1, dtype=np.int32)
        np.add.at(edge, np.clip(first - left, 0, len(key)), 1)
        np.add.at(edge, np.clip(last - left, 0, len(key)), -1)
        key = key[(np.cumsum(edge[:-1]) > 0) & (key >> 32 < UNRANKED)]
        wins = np.bincount(key & 0xFFFFFFFF, minlength=n)
        at = np.flatnonzero(wins >= POPULAR) + left
        found.append(at[(at >= lo) & (at < lo + BLOCK)])
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def _hashed(rows: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte rows whose width is a multiple of 8 (or under 8)."""
    if rows.shape[1] % 8:
        rows = np.pad(rows, ((0, 0), (0, 8 - rows.shape[1] % 8)))
    parts = np.ascontiguousarray(rows).view("<u8")
    out = np.full(len(rows), U64(0x9E3779B97F4A7C15))
    with np.errstate(over="ignore"):
        for k in range(parts.shape[1]):
            out = mix(out ^ parts[:, k]) + U64(k + 1)
    return out


def _whole(raw: bytes) -> int:
    return int.from_bytes(hashlib.sha256(raw).digest()[:8], "little")


def feature_hashes(data: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray, ranks: np.ndarray) -> list[np.ndarray]:
    """Per text ``data[offsets[i]:offsets[i + 1]]``: hashes of its different features in order."""
    first, end = offsets[:-1], offsets[1:]
    long = (n_chars >= SHORT) & (end - first >= WINDOW + NEIGHBOURS - 1)
    at = popular(data, first[long], end[long], ranks) if long.any() else np.zeros(0, dtype=np.int64)
    cut = np.searchsorted(at, offsets)
    hashes = _hashed(data[at[:, None] + np.arange(WINDOW)]) if len(at) else np.zeros(0, dtype=U64)
    out = []
    for i in range(len(first)):
        own = hashes[cut[i]:cut[i + 1]] if long[i] else np.zeros(0, dtype=U64)
        size = int(end[i] - first[i])
        if not long[i] and size >= SHORT_WINDOW:
            own = _hashed(np.lib.stride_tricks.sliding_window_view(data[first[i]:end[i]], SHORT_WINDOW))
        if size and not len(own):
            own = np.array([_whole(data[first[i]:end[i]].tobytes())], dtype=U64)
        seen = np.unique(own, return_index=True)[1]
        out.append(own[np.sort(seen)])
    return out


def filters_of(hashes: np.ndarray) -> np.ndarray:
    """Chained filters (rows of BITS / 8 bytes)."""
    n = -(-len(hashes) // FEATURES)
    bits = np.zeros((n, BITS), dtype=np.uint8)
    of = np.arange(len(hashes)) // FEATURES
    width = U64((BITS - 1).bit_length())
    for k in range(HASHES):
        bits[of, (hashes >> (U64(k) * width)) & U64(BITS - 1)] = 1
    return np.packbits(bits, axis=1)


def fingerprints(texts: list[str], ranks: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(window, features, filters) of each text."""
    n_chars = np.array([len(t) for t in texts], dtype=np.int64)
    out = []
    for chunk in chunks(pa.array(texts, pa.large_string()), lower=False, limit=TEXT_BYTES):
        sizes = n_chars[chunk.first:chunk.first + len(chunk)]
        for n, hashes in zip(sizes, feature_hashes(chunk.data, chunk.offsets, sizes, ranks), strict=True):
            out.append((WINDOW if n >= SHORT else SHORT_WINDOW, len(hashes), filters_of(hashes)))
    return out


def as_text(print_: tuple[int, int, np.ndarray]) -> str:
    window, n, filters = print_
    return f"{window}-{n}-{base64.b64encode(filters.tobytes()).decode()}"


def from_text(fingerprint: str) -> tuple[int, int, np.ndarray]:
    window, n, body = fingerprint.split("-", 2)
    return int(window), int(n), np.frombuffer(base64.b64decode(body), dtype=np.uint8).reshape(-1, BITS // 8)


def likeness(a: tuple[int, int, np.ndarray], b: tuple[int, int, np.ndarray]) -> float:
    """Normalised bit overlap of two fingerprints, 0 to 1."""
    if not a[1] or not b[1]:
        return float(a[1] == b[1])
    if a[0] != b[0]:
        return 0.0
    fewer, more = sorted((a[2], b[2]), key=lambda f: (len(f), int(np.bitwise_count(f).sum())))
    other = np.unpackbits(more, axis=1).astype(np.float32)
    size = other.sum(axis=1, dtype=np.float64)
    total = weight = 0.0
    for lo in range(0, len(fewer), 256):
        own = np.unpackbits(fewer[lo:lo + 256], axis=1).astype(np.float32)
        bits = own.sum(axis=1, dtype=np.float64)
        best = np.zeros(len(own))
        for at in range(0, len(other), 4096):
            chance = bits[:, None] * size[at:at + 4096] / BITS
            common = own @ other[at:at + 4096].T - chance
            most = np.minimum(bits[:, None], size[at:at + 4096]) - chance
            best = np.maximum(best, (common / most).max(axis=1))
        total += float((np.minimum(best, 1.0) * bits).sum())
        weight += float(bits.sum())
    return total / weight


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of the next one, or all of that."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def corpus_ranks(documents: DataFrame) -> np.ndarray:
    """Ranks of the entropy classes from all windows of all texts; CLASSES rows reach the driver."""
    def count(batches):
        total = np.zeros(CLASSES, dtype=np.int64)
        for batch in batches:
            for chunk in chunks(batch.column(0), lower=False, limit=TEXT_BYTES):
                total += histogram(chunk.data, chunk.offsets[:-1], chunk.offsets[1:])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(total)], names=["class", "n"])

    rows = documents.select("text").mapInArrow(count, "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(CLASSES, dtype=np.int64)
    for row in rows:
        counts[row["class"]] = row["n"]
    return ranks_of(counts)


_RESULT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.binary()),
           ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_ROW = pa.schema([*_RESULT, ("piece", pa.int32()), ("head", pa.bool_()), ("open", pa.bool_()), ("text", pa.string())])
_RESULT_DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
               "near_edited double, near_next double")
_ROW_DDL = _RESULT_DDL + ", piece int, head boolean, open boolean, text string"


def _packed(print_: tuple[int, int, np.ndarray]) -> bytes:
    """Window (1 byte), features (8 bytes), filters: less to store than ``as_text``."""
    return bytes([print_[0]]) + print_[1].to_bytes(8, "big") + print_[2].tobytes()


def _judged(doc_id, text: str, own, changed: str, changed_print, following) -> dict:
    return {"doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
            "fingerprint": _packed(own), "edited_fingerprint": _packed(changed_print),
            "near_edited": likeness(own, changed_print), "near_next": likeness(own, following)}


def _parts(batches) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts, some at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, TEXT_ROWS):
            part = batch.slice(lo, TEXT_ROWS)
            yield part.column(0).to_pylist(), [t or "" for t in part.column(1).to_pylist()]


def _digest(batches, ranks: np.ndarray):
    """Sorted documents of a partition, each with the next one; the last stays open."""
    from pyspark import TaskContext

    piece, held, first = TaskContext.get().partitionId(), [], True
    for ids, texts in _parts(batches):
        held += list(zip(ids, texts, fingerprints(texts, ranks), strict=True))
        pairs = list(zip(held, held[1:], strict=False))
        changes = [edited(a[1], b[1]) for a, b in pairs]
        rows = []
        for (a, b), changed, print_ in zip(pairs, changes, fingerprints(changes, ranks), strict=True):
            rows.append(_judged(*a, changed, print_, b[2]) | {"piece": piece, "head": first, "open": False, "text": a[1] if first else None})
            first = False
        held = held[-1:]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ROW)
    for doc_id, text, own in held:
        yield pa.RecordBatch.from_pylist([{"doc_id": doc_id, "n_chars": len(text), "fingerprint": _packed(own), "piece": piece,
                                           "head": first, "open": True, "text": text}], schema=_ROW)


def _close(batches, ranks: np.ndarray):
    """Open rows with the text of the first document of the next partition."""
    for batch in batches:
        for row in batch.to_pylist():
            own, following = fingerprints([row["text"], row["following"]], ranks)
            changed = edited(row["text"], row["following"])
            result = _judged(row["doc_id"], row["text"], own, changed, fingerprints([changed], ranks)[0], following)
            yield pa.RecordBatch.from_pylist([result], schema=pa.schema(_RESULT))


def fingerprint_neighbours(documents: DataFrame, ranks: np.ndarray | None = None) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (packed), near_edited, near_next.

    The edited text has its last quarter replaced from the next document, by ascending doc_id."""
    spark = documents.sparkSession
    ranks = corpus_ranks(documents) if ranks is None else ranks
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                            F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("copy"))
    order = ["doc_id", "tie", "copy"]  # the copy deals rows that are equal throughout
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    found = stored(dealt.mapInArrow(lambda batches: _digest(batches, ranks), _ROW_DDL))
    pieces = sorted(r.piece for r in found.where("open").select("piece").collect())  # one number per partition
    turn = spark.createDataFrame(list(zip(pieces, pieces[1:] + pieces[:1], strict=True)), "piece int, next int")
    heads = found.where("head").select(F.col("piece").alias("next"), F.col("text").alias("following"))
    last = found.where("open").select("piece", "doc_id", "text").join(turn, "piece").join(heads, "next").select("doc_id", "text", "following")
    closed = last.mapInArrow(lambda batches: _close(batches, ranks), _RESULT_DDL)
    return found.where("NOT open").select(*closed.columns).unionByName(closed)


def report(found: DataFrame) -> DataFrame:
    """The packed fingerprints as text: ``window-features-filters``."""
    def text(name):
        packed = F.col(name)
        window = F.conv(F.hex(F.substring(packed, 1, 1)), 16, 10)
        features = F.conv(F.hex(F.substring(packed, 2, 8)), 16, 10)
        body = F.translate(F.base64(F.expr(f"substring({name}, 10)")), "\r\n", "")  # Spark may break the lines
        return F.concat_ws("-", window, features, body).alias(name)

    return found.select("doc_id", "n_chars", "edited_sha256", text("fingerprint"), text("edited_fingerprint"), "near_edited", "near_next")
