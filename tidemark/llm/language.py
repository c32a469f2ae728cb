"""Language ID as mixture inference: expectation-maximisation over n-gram likelihoods.

Every learned language has a distribution of byte trigrams (hashed to ``BUCKETS``, word-bounded, lower
case), counted over all training documents.  A document is a mixture: each word comes from one language.
Expectation-maximisation estimates the proportions from the words' likelihoods; the language set is
chosen by penalised likelihood, from the best single language to larger sets as long as the gain in log
likelihood exceeds ``PENALTY * log(words)`` and ``MIN_GAIN`` per word for each language added.

Defined results: ``und`` with score 0 for a null text, a text without a letter, or when nothing could be
learned; ties go to the first language in alphabetical order; repeated rows each give their row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrowtext import Chunk, byte_class, chunks, words
from tidemark.llm.tables import held_out

BUCKETS = 1 << 16
SMOOTHING = 0.5
ROUNDS = 12
PENALTY = 3.0
MIN_GAIN = 0.02
# FIXED VALUES: separators of the word rule used here, the ASCII characters that are no letters.
NOT_LETTER = byte_class(bytes(b for b in range(128) if not (65 <= b <= 90 or 97 <= b <= 122)))


def _padded(chunk: Chunk) -> Chunk:
    """The same texts with one separator after each, so that word ends have a boundary byte."""
    data = np.insert(chunk.data, chunk.offsets[1:], 32)
    return Chunk(chunk.first, np.where(NOT_LETTER[data], np.uint8(32), data),
                 chunk.offsets + np.arange(len(chunk.offsets)), chunk.valid)


def trigrams(column: pa.Array):
    """(trigram bucket per kept byte, word spans within them, chunk) of chunks of whole texts.

    Kept bytes are those of the words and one boundary after each word."""
    for chunk in chunks(pc.utf8_lower(column.cast(pa.large_string())), lower=False):
        chunk = _padded(chunk)
        found = words(chunk, NOT_LETTER)
        # a word's trigrams start with its boundary before: (' ', a, b), (a, b, c), ..., (y, z, ' ')
        data = chunk.data.astype(np.uint32)
        before = np.empty_like(data)
        before[1:], before[:1] = data[:-1], 32
        after = np.empty_like(data)
        after[:-1], after[-1:] = data[1:], 32
        bucket = ((before * np.uint32(0x9E3779B1) ^ data * np.uint32(0x85EBCA77) ^ after * np.uint32(0xC2B2AE3D))
                  * np.uint32(0x27D4EB2F)) >> np.uint32(16)
        yield bucket, found, chunk


@dataclass
class Model:
    """Log probabilities [language, bucket]; one row of 256 KB per learned language."""

    languages: list[str]
    log_p: np.ndarray


def fit(documents: DataFrame) -> Model:
    """Count trigrams by language over all training rows (labelled and not held out)."""
    rows = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))) \
        .select("lang", "text")

    def count(batches):
        for batch in batches:
            names = batch.column(0).dictionary_encode()
            code = np.asarray(names.indices)
            values = names.dictionary.to_pylist()
            lo = 0
            total = np.zeros((len(values), BUCKETS), dtype=np.int64)
            for bucket, found, chunk in trigrams(batch.column(1)):
                inside = ~NOT_LETTER[chunk.data]
                text = np.repeat(np.arange(len(chunk)), np.diff(chunk.offsets))[inside]
                key = code[lo:lo + len(chunk)][text] * BUCKETS + bucket[inside]
                total += np.bincount(key, minlength=total.size).reshape(total.shape)
                lo += len(chunk)
            lang, at = np.nonzero(total)
            if len(lang):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([values[i] for i in lang.tolist()]), pa.array(at.astype(np.int32)), pa.array(total[lang, at])],
                    names=["lang", "bucket", "n"])

    counts = rows.mapInArrow(lambda batches: count(b for b in batches if b.num_rows), "lang string, bucket int, n long") \
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")) \
        .groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("c")).collect()  # BUCKETS entries a language
    languages = sorted(r["lang"] for r in counts)
    table = np.full((len(languages), BUCKETS), SMOOTHING)
    for r in counts:
        at, n = zip(*r["c"], strict=True)
        table[languages.index(r["lang"]), list(at)] += n
    return Model(languages, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def _em(weight: np.ndarray, first: np.ndarray, text: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions [text, language] over the allowed languages, and the log likelihood of the scaled weights."""
    n = np.diff(first)[:, None]
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        part = weight * share[text]
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-30)
        share = np.add.reduceat(part, first[:-1], axis=0) / n
    likelihood = np.log(np.maximum((weight * share[text]).sum(axis=1), 1e-30))
    return share, np.add.reduceat(likelihood, first[:-1])


def mixtures(log_word: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Chosen proportions [text, language] of texts with words; ``log_word`` [word, language]."""
    n_texts, n_languages = len(first) - 1, log_word.shape[1]
    text = np.repeat(np.arange(n_texts), np.diff(first))
    weight = np.exp(log_word - log_word.max(axis=1, keepdims=True))
    full, _ = _em(weight, first, text, np.ones((n_texts, n_languages), dtype=np.float32))
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1, kind="stable")
    # one language: the best total likelihood (floored per word, as in the mixtures)
    single = np.add.reduceat(np.log(np.maximum(weight, 1e-30)), first[:-1], axis=0)
    best = single.argmax(axis=1)
    chosen = np.zeros((n_texts, n_languages))
    chosen[np.arange(n_texts), best] = 1
    value = single[np.arange(n_texts), best]
    n = np.diff(first)
    step = PENALTY * np.log(n + 1) + MIN_GAIN * n
    open_ = np.flatnonzero(full.max(axis=1) < 0.995)
    for size in range(2, n_languages + 1):
        if not open_.size:
            break
        length = n[open_]
        own_first = np.concatenate(([0], np.cumsum(length)))
        rows = np.repeat(first[:-1][open_] - own_first[:-1], length) + np.arange(own_first[-1])
        share, likelihood = _em(weight[rows], own_first, np.repeat(np.arange(len(open_)), length),
                                (rank[open_] < size).astype(np.float32))
        better = likelihood - value[open_] > step[open_]
        chosen[open_[better]] = share[better]
        value[open_[better]] = likelihood[better]
        open_ = open_[better]
    return chosen


def _has_letter(column: pa.Array) -> np.ndarray:
    return np.asarray(pc.match_substring_regex(column, r"\p{L}").fill_null(False))


def detect(column: pa.Array, model: Model) -> tuple[list[str], np.ndarray, list[list[dict]]]:
    """(language, its share, all chosen languages with shares) per text."""
    names, scores, shares = [], [], []
    for bucket, found, chunk in trigrams(column):
        n = found.counts()
        some = np.flatnonzero(n > 0)
        first = np.concatenate(([0], np.cumsum(n[some])))
        pred, score = np.full(len(chunk), -1), np.zeros(len(chunk))
        sets: list[list[dict]] = [[] for _ in range(len(chunk))]
        if len(some) and model.languages:
            inside = ~NOT_LETTER[chunk.data]
            kept = bucket[inside]
            length = found.ends - found.starts
            starts = np.cumsum(length) - length
            log_word = np.stack([np.add.reduceat(row[kept], starts) for row in model.log_p], axis=1)
            chosen = mixtures(log_word, first)
            pred[some], score[some] = chosen.argmax(axis=1), chosen.max(axis=1)
            for t, row in zip(some.tolist(), chosen, strict=True):
                sets[t] = [{"lang": model.languages[j], "share": float(row[j])} for j in np.argsort(-row, kind="stable") if row[j] > 0]
        names.extend(model.languages[p] if p >= 0 else "und" for p in pred.tolist())
        scores.append(score)
        shares.extend(sets)
    score = np.concatenate(scores) if scores else np.zeros(0)
    letters = _has_letter(column.cast(pa.large_string()))
    for i in np.flatnonzero(~letters).tolist():
        names[i], score[i], shares[i] = "und", 0.0, []
    return names, np.clip(score, 0, 1), shares


def identify(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """Per document row: doc_id, held_out, lang_pred, score, languages (lang, share)."""
    shared = documents.sparkSession.sparkContext.broadcast(model or fit(documents))
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                names, score, shares = detect(batch.column(1), shared.value)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names), pa.array(score), pa.array(shares, kind)],
                                                 names=["doc_id", "lang_pred", "score", "languages"])

    out = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, languages array<struct<lang:string,share:double>>")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "languages")
