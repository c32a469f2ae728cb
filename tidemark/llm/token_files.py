"""Token-ID output: whole texts as token ids in range-coded, checksummed blocks.

File format: a folder of Parquet files, one row per block of up to ``BLOCK_IDS`` ids.  Blocks of a shard
follow one another; shards follow in ascending document order, and inside a shard documents follow one
another with an end id after each.  Columns:

* ``shard``, ``block`` - place of the block; ``n_ids`` - ids in it
* ``crc32`` - of the ids as little-endian unsigned 32-bit integers
* ``first_doc`` - place in the block where the first document of ``docs`` starts
* ``docs`` - (doc_id, n_tokens) of the documents that start in the block, in order
* ``payload`` - the ids, coded by ``range_coder`` from its starting state

Any block can be decoded alone.  Spark's committed Parquet writer makes the files, so a lost executor leaves
no half-written shard, and they can live in any store that Spark reaches.

Defined results: a null text is empty and has the end id only; repeated rows are separate documents; rows
without id come first; an empty table gives an empty folder.  A block whose ids do not match its checksum
raises.
"""

from __future__ import annotations

import ctypes
import gc
import json
import os
import re
import uuid
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import range_coder
from tidemark.llm.tables import shared_folder

BLOCK_IDS = 8192
LANES = 512
END_ID = 2
TEXTS_PER_CALL = 256
MAX_WORDS, MAX_PIECES = 1 << 19, 1 << 19
MAX_WORD_BYTES = 64

#: Normalisation and splitting that never look across white space: texts may be encoded word by word.
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_LETTER, _NUMBER = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^ \t-\r\x85\xa0{_LETTER}{_NUMBER}]+")

_tokenizers: dict = {}


class _WordTokenizer:
    """A tokenizer that keeps the ids of the words and of the pieces of words that it met, in bounded tables.

    Where a word (between ASCII white space) has the same ids in every text, each different piece goes through the library once,
    and a text's ids are those of its words in order.  Other tokenizers get whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tool, self.words, self.pieces = Tokenizer.from_file(path), {}, {}
        rules = json.loads(self.tool.to_str())
        model, added = rules["model"], rules["added_tokens"]
        self.by_words = (
            rules["normalizer"] == _NORMALIZER and rules["pre_tokenizer"] == _PRE_TOKENIZER and model["type"] == "BPE"
            and not model["dropout"] and not model["continuing_subword_prefix"] and bool(suffix := model["end_of_word_suffix"])
            and not rules["truncation"] and not rules["padding"]
            and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] or a["content"].split() != [a["content"]] for a in added))
        if self.by_words:
            self.odd = re.compile("|".join(["[^\x00-\xff]", *(re.escape(a["content"]) for a in added)]))
            self.ends = np.zeros(self.tool.get_vocab_size(), dtype=bool)  # ids that end a piece
            self.ends[[i for token, i in model["vocab"].items() if token.endswith(suffix)]] = True

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [_narrow(e.ids) for e in self.tool.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Pieces go to the library as one text, each is over where an id ends a piece."""
        texts = [p.decode() for p in pieces]
        ids = np.frombuffer(self._encode([" ".join(texts)])[0], dtype="<u2")
        ends = 2 * np.flatnonzero(self.ends[ids]) + 2
        if len(ends) != len(pieces) or ends[-1] != 2 * len(ids):
            return self._encode(texts)
        raw, to = ids.tobytes(), ends.tolist()
        return [raw[a:b] for a, b in zip([0, *to], to, strict=False)]

    def _words(self, words: list[bytes]) -> list[bytes]:
        """Words of Latin-1 characters by their pieces, others one by one."""
        split, odd = [], []  # pieces with a blank between them: no list per word
        for w in words:
            text = w.decode()
            if self.odd.search(text):
                split.append(None)
                odd.append(text)
            elif text.isalpha():
                split.append(text.lower().encode())
            else:
                split.append(" ".join(_PIECES.findall(text.lower())).encode())
        used = set(b" ".join(filter(None, split)).split())
        new = used.difference(self.pieces)
        if len(self.pieces) + len(new) > MAX_PIECES:
            self.pieces.clear()
            new = used
        if new := list(new):
            self.pieces.update(zip(new, self._pieces(new), strict=True))
        ids, rest, out = self.pieces, iter(self._encode(odd)), []
        for parts in split:
            if parts is None:
                out.append(next(rest))
            elif (one := ids.get(parts)) is not None:
                out.append(one)
            else:
                out.append(b"".join(map(ids.__getitem__, parts.split(b" "))) if parts else b"")
        for p in new:
            if len(p) > MAX_WORD_BYTES:
                del ids[p]
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Per UTF-8 text its ids, as little-endian unsigned 16-bit integers."""
        if not self.by_words:
            return self._encode([t.decode() for t in texts])
        words = [t.split() for t in texts]
        used = set(chain.from_iterable(words))
        new = used.difference(self.words)
        if len(self.words) + len(new) > MAX_WORDS:
            self.words.clear()
            new = used
        new, ids = list(new), self.words
        ids.update(zip(new, self._words(new), strict=True))
        out = [b"".join(map(ids.__getitem__, w)) for w in words]
        for w in new:
            if len(w) > MAX_WORD_BYTES:
                del ids[w]
        return out


def _tokenizer(path: str) -> _WordTokenizer:
    """The tokenizer of a file, loaded once per worker."""
    if path not in _tokenizers:
        _tokenizers[path] = _WordTokenizer(path)
    return _tokenizers[path]


def release() -> None:
    """Give back what earlier stages left in this worker: tokenizers, and freed memory that the allocators keep."""
    _tokenizers.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def _narrow(ids: list[int]) -> bytes:
    wide = np.array(ids, dtype=np.int64)
    if len(wide) and wide.max() > 0xFFFF:
        raise ValueError("the file format holds ids up to 65,535")
    return wide.astype("<u2").tobytes()


def token_ids(documents: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids): the ids of each whole text and the end id, as little-endian unsigned 16-bit integers."""
    def encode(batches):
        tool, end = _tokenizer(tokenizer_path), _narrow([end_id])
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for lo in range(0, batch.num_rows, TEXTS_PER_CALL):
                ids = [found + end for found in tool.encode([t or b"" for t in texts.slice(lo, TEXTS_PER_CALL).to_pylist()])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, TEXTS_PER_CALL), pa.array(ids, pa.binary())],
                                                 names=["doc_id", "ids"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, "doc_id long, ids binary")


BLOCK_SCHEMA = ("shard int, block int, n_ids int, crc32 long, first_doc int, "
                "docs array<struct<doc_id:long,n_tokens:long>>, payload binary")
_BLOCK_ARROW = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int32()), ("crc32", pa.int64()), ("first_doc", pa.int32()),
    ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("n_tokens", pa.int64())]))), ("payload", pa.binary())])


def _checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _blocks(batches, shard: int, vocabulary: int):
    """Rows of the blocks of one shard, ``LANES`` blocks at a time."""
    parts: list[np.ndarray] = []
    starts: list[tuple[int, int, int]] = []  # place, doc_id, n_tokens of the documents that start in ``parts``
    size = block = 0

    def emit(n_ids):
        nonlocal parts, starts, size, block
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint16)
        cuts = list(range(0, n_ids, BLOCK_IDS))
        pieces = [ids[c:min(c + BLOCK_IDS, n_ids)] for c in cuts]
        rows, at = [], 0
        for c, piece, payload in zip(cuts, pieces, range_coder.encode(pieces, vocabulary), strict=True):
            first = at
            while at < len(starts) and starts[at][0] < c + len(piece):
                at += 1
            rows.append({"shard": shard, "block": block, "n_ids": len(piece), "crc32": _checksum(piece),
                         "first_doc": starts[first][0] - c if at > first else -1,
                         "docs": [{"doc_id": d, "n_tokens": n} for _, d, n in starts[first:at]], "payload": payload})
            block += 1
        parts, starts = [ids[n_ids:]], [(p - n_ids, d, n) for p, d, n in starts[at:]]
        size -= n_ids
        return pa.RecordBatch.from_pylist(rows, schema=_BLOCK_ARROW)

    for batch in batches:
        for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = np.frombuffer(raw, dtype="<u2")
            starts.append((size, doc_id, len(ids)))
            parts.append(ids)
            size += len(ids)
            while size >= LANES * BLOCK_IDS:
                yield emit(LANES * BLOCK_IDS)
    if size:
        yield emit(size)


def write_token_files(documents: DataFrame, tokenizer_path: str, folder: str, vocabulary: int = 49_408) -> None:
    """Encode every document and write the block files, in ascending doc_id order."""
    def write(batches):
        from pyspark import TaskContext

        yield from _blocks(batches, TaskContext.get().partitionId(), vocabulary)

    # the texts are put in order, not their ids: finding the ranges reads the table, but tokenises nothing
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    ordered = texts.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    token_ids(ordered, tokenizer_path).mapInArrow(write, BLOCK_SCHEMA).write.parquet(folder)


def _documents(batches, vocabulary: int, with_ids: bool):
    """(shard, doc_id, start in the shard, n_tokens, crc32[, ids]) of blocks in order."""
    names = ["shard", "doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    state = {"shard": None, "at": 0, "open": [], "parts": [], "have": 0}

    def take(rows):
        out = []
        decoded = range_coder.decode([r["payload"] for r in rows], [r["n_ids"] for r in rows], vocabulary)
        for row, ids in zip(rows, decoded, strict=True):
            if _checksum(ids) != row["crc32"]:
                raise ValueError(f"block {row['block']} of shard {row['shard']} does not match its checksum")
            if row["shard"] != state["shard"]:
                state.update(shard=row["shard"], at=0, open=[], parts=[], have=0)
            state["parts"].append(ids)
            state["have"] += len(ids)
            state["open"].extend(row["docs"])
            if not state["open"] or state["have"] < state["open"][0]["n_tokens"]:
                continue
            stream, used = np.concatenate(state["parts"]), 0
            done = 0
            for doc in state["open"]:
                if len(stream) - used < doc["n_tokens"]:
                    break
                own = stream[used:used + doc["n_tokens"]].astype("<u4").tobytes()
                used += doc["n_tokens"]
                out.append((row["shard"], doc["doc_id"], state["at"], doc["n_tokens"], zlib.crc32(own)) + ((own,) if with_ids else ()))
                state["at"] += doc["n_tokens"]
                done += 1
            state["open"] = state["open"][done:]
            state["parts"], state["have"] = [stream[used:]], len(stream) - used
        if out:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), *[pa.int64()] * 4, pa.binary()), strict=False)],
                names=names)

    waiting: list[dict] = []
    for batch in batches:
        for lo in range(0, batch.num_rows, LANES):
            waiting.extend(batch.slice(lo, LANES).to_pylist())
            while len(waiting) >= LANES:
                if (found := take(waiting[:LANES])) is not None:
                    yield found
                waiting = waiting[LANES:]
    if waiting and (found := take(waiting)) is not None:
        yield found


def read_token_files(spark: SparkSession, folder: str, vocabulary: int = 49_408, with_ids: bool = False) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and on request
    the ids (little-endian unsigned 32-bit integers)."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(folder)
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # one row per shard
    before = sizes.select("shard", F.coalesce(F.sum("n").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    docs = blocks.select("shard", "block", "n_ids", "crc32", "docs", "payload").repartition("shard") \
        .sortWithinPartitions("shard", "block").mapInArrow(
            lambda batches: _documents(batches, vocabulary, with_ids),
            "shard int, doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
    return docs.join(before, "shard").select(
        "doc_id", (F.col("before") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def token_output(documents: DataFrame, tokenizer_path: str, folder: str | None = None) -> DataFrame:
    """Write the files (into the shared folder unless one is given) and return what they hold."""
    spark = documents.sparkSession
    folder = folder or f"{shared_folder(spark)}/token_files/{uuid.uuid4().hex}"
    write_token_files(documents, tokenizer_path, folder)
    return read_token_files(spark, folder)
