"""Toxicity by nearest labelled examples: exact TF-IDF cosine, block-max inverted index, weighted votes.

* Terms are whole words and word beginnings (4, 5 and 6 bytes), lower-cased.  The term space holds those
  that mark the label: at least ``MIN_DOCS`` examples, at least twice the base rate of label 1, and a log-likelihood
  ratio of at least ``MIN_EVIDENCE``: all of them, however many.  Labels are learned from a bounded sample of the
  training rows (``MAX_EXAMPLES``, by hash of the id), one example per near-copy family (two min-hashes).
* Document frequencies are counted over all documents.
* Examples are kept in blocks of similar ones.  For each (term, block) the index holds the largest weight;
  a query's bound for a block is the sum of its term weights times these.  Blocks are opened from the
  highest bound down until no bound reaches the k-th best cosine, so the neighbours are exact.
* The vote is the share of label 1 among the neighbours, weighted by squared cosine, with one prior
  pseudo-example; an isotonic fit of the votes of the examples themselves (each without itself)
  calibrates it.  The neighbours are returned as evidence.

Defined results: a null or empty text, or one without any selected term, gets the smoothed rate of the
examples without such terms; without labels every score is 0; of several labels for one id the largest counts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrowtext import NOT_ALNUM, SpanHasher, U64, chunks, mix, words
from tidemark.llm.tables import held_out, stored
from tidemark.llm.token_files import release

MAX_EXAMPLES = 20_000
TEXT_BYTES = 1 << 20
BATCH_ROWS = 1024
MIN_DOCS = 5
MIN_EVIDENCE = 20.0
PREFIXES = (4, 5, 6)
LEVELS = (2, 3)
BLOCK = 64
NEIGHBOURS = 15
SCORE, EVIDENCE = "__score", "__evidence"


def _terms(column: pa.Array):
    """(term hash, text index, count) of the distinct terms of chunks of whole texts, and the number of texts.

    Terms are all words and word beginnings; one found twice, or three times and more, adds a further
    term for that level, because a stem that marks label 1 when repeated can be chance when single."""
    for chunk in chunks(column, limit=TEXT_BYTES):
        found = words(chunk, NOT_ALNUM)
        spans = SpanHasher(chunk)
        text = np.repeat(np.arange(len(chunk)), found.counts())
        length = found.ends - found.starts
        values, owners = [spans(found.starts, found.ends)], [text]
        for i, n in enumerate(PREFIXES):
            long_enough = length > n
            starts = found.starts[long_enough]
            values.append(mix(spans(starts, starts + n) ^ U64(i + 1)))
            owners.append(text[long_enough])
        value, owner = np.concatenate(values), np.concatenate(owners)
        yield value, owner, len(chunk)


def _counted(value: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """(term, text, count, term without level) of the distinct terms and their level terms."""
    order = np.lexsort((owner, value))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(value)))
    value, owner = value[start], owner[start]
    levels = [(value, owner, count, value)]
    for level in LEVELS:
        more = count >= level
        levels.append((level_term(value[more], level), owner[more], np.ones(int(more.sum()), dtype=np.int64),
                       value[more]))
    return tuple(np.concatenate(x) for x in zip(*levels, strict=True))


def level_term(value: np.ndarray, level: int) -> np.ndarray:
    return mix(value ^ (U64(level) << U64(32)))


@dataclass
class Model:
    """Everything a scoring task needs; its size is bounded by MAX_EXAMPLES and the terms that they hold."""

    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    bases: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))  # terms without their level
    gate: np.ndarray | None = None  # by the last 16 bits of a base
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    prior: float = 0.0
    empty_rate: float = 0.0
    example: np.ndarray | None = None  # doc_id, copies, toxic copies of each distinct example vector
    entries: tuple | None = None  # (vector, term, weight)
    knots: tuple | None = None
    _index: tuple | None = None

    def select(self, values, owners):
        """(term number, text, count) of the terms of the term space."""
        near = np.flatnonzero(self.gate[(values & U64(0xFFFF)).astype(np.int64)])
        values, owners = values[near], owners[near]
        at = np.minimum(np.searchsorted(self.bases, values), len(self.bases) - 1)
        hit = self.bases[at] == values
        value, owner, count, _ = _counted(values[hit], owners[hit])
        at = np.minimum(np.searchsorted(self.terms, value), len(self.terms) - 1)
        hit = self.terms[at] == value
        return at[hit], owner[hit], count[hit]

    def vectors(self, values, owners, n_texts):
        """TF-IDF vectors of unit length: (text, term, weight) sorted by text."""
        if not len(self.terms):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
        term, text, count = self.select(values, owners)
        order = np.lexsort((term, text))
        term, text, count = term[order], text[order], count[order]
        weight = (1 + np.log(count)) * self.idf[term]
        norm = np.sqrt(np.bincount(text, weights=weight * weight, minlength=n_texts))
        return text, term, (weight / norm[text]).astype(np.float32)

    def blocks(self):
        """Block maxima [term, block], and the entries sorted by (block, term) with the first entry of each block."""
        if self._index is None:
            n_blocks = -(-len(self.example) // BLOCK)
            vector, term, weight = self.entries
            order = np.lexsort((term, vector // BLOCK))
            vector, term, weight = vector[order], term[order], weight[order]
            maxima = np.zeros((len(self.terms), n_blocks), dtype=np.float32)
            np.maximum.at(maxima, (term, vector // BLOCK), weight)
            self._index = maxima, vector, term, weight, np.searchsorted(vector // BLOCK, np.arange(n_blocks + 1))
        return self._index

    def opened(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """The terms of a block and their weights (term, example in block); the last row, of zeros, is for all others."""
        _, vector, term, weight, first = self.blocks()
        own = slice(first[number], first[number + 1])
        terms, row = np.unique(term[own], return_inverse=True)
        table = np.zeros((len(terms) + 1, BLOCK), dtype=np.float32)
        table[row, vector[own] % BLOCK] = weight[own]
        return terms, table

    def nearest(self, text, term, weight, skip=None, k: int = NEIGHBOURS):
        """(queries, example index or -1, cosine) of the k best examples of every query with a vector.

        ``skip``: doc_id per text whose own copy is taken out of an example's counts by the caller."""
        queries, starts = np.unique(text, return_index=True)
        k = min(k, len(self.example))
        best = np.zeros((len(queries), k), dtype=np.float32)
        index = np.full((len(queries), k), -1, dtype=np.int64)
        maxima = self.blocks()[0]
        bounds = np.append(starts, len(text))
        slice_size = max(1, 4_000_000 // (max(1, maxima.shape[1]) * 8))
        for lo in range(0, len(queries), slice_size):
            hi = min(lo + slice_size, len(queries))
            a, b = bounds[lo], bounds[hi]
            bound = np.add.reduceat(maxima[term[a:b]] * weight[a:b, None], bounds[lo:hi] - a, axis=0)
            order = np.argsort(-bound, axis=1, kind="stable")
            going = np.arange(hi - lo)
            for step in range(bound.shape[1]):
                block = order[going, step]
                reach = bound[going, block] * np.float32(1.00001)
                open_ = (reach > 0) & (reach >= best[lo + going, -1])
                going, block = going[open_], block[open_]
                if not going.size:
                    break
                by_block = np.argsort(block, kind="stable")
                edges = np.flatnonzero(np.diff(block[by_block], prepend=-1))
                for part in np.split(by_block, edges[1:]):
                    rows, number = going[part] + lo, int(block[part[0]])
                    size = bounds[rows + 1] - bounds[rows]
                    entry = np.repeat(bounds[rows] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                    terms, table = self.opened(number)
                    row = np.minimum(np.searchsorted(terms, term[entry]), len(terms) - 1)
                    row = np.where(terms[row] == term[entry], row, len(terms))
                    cosine = np.add.reduceat(table[row] * weight[entry, None], np.cumsum(size) - size, axis=0)
                    ids = np.where(cosine > 0, number * BLOCK + np.arange(BLOCK), -1)
                    both = np.concatenate((best[rows], cosine), axis=1)
                    both_ids = np.concatenate((index[rows], ids), axis=1)
                    # ties: the smaller example number first
                    top = np.lexsort((np.where(both_ids < 0, 1 << 40, both_ids), -both), axis=1)[:, :k]
                    best[rows] = np.take_along_axis(both, top, axis=1)
                    index[rows] = np.take_along_axis(both_ids, top, axis=1)
        return queries, index, np.where(index >= 0, best, 0)

    def votes(self, index, cosine, own=None):
        """Weighted share of label 1, with the prior as one pseudo-example."""
        weight = cosine.astype(np.float64) ** 2
        copies = np.where(index >= 0, self.example["copies"][index], 0).astype(np.float64)
        toxic = np.where(index >= 0, self.example["toxic"][index], 0).astype(np.float64)
        if own is not None:  # (example number, label) of the query itself
            itself = index == own[0][:, None]
            copies -= itself
            toxic -= itself * own[1][:, None]
        return ((weight * toxic).sum(axis=1) + self.prior) / ((weight * copies).sum(axis=1) + 1)

    def calibrated(self, vote):
        return vote if self.knots is None else np.interp(vote, *self.knots)

    def judged(self, values, owners, n_texts):
        """(score per text, texts with neighbours, their neighbours, cosines)."""
        score = np.full(n_texts, self.empty_rate)
        text, term, weight = self.vectors(values, owners, n_texts)
        if not len(text) or self.example is None or not len(self.example):
            return score, None, None, None
        queries, index, cosine = self.nearest(text, term, weight)
        score[queries] = self.calibrated(self.votes(index, cosine))
        return score, queries, index, cosine

    def score_only(self, values, owners, n_texts):
        return np.clip(self.judged(values, owners, n_texts)[0], 0, 1)

    def scores(self, values, owners, n_texts):
        """(score per text, evidence per text)."""
        evidence: list[list[dict]] = [[] for _ in range(n_texts)]
        score, queries, index, cosine = self.judged(values, owners, n_texts)
        if queries is not None:
            for q, ids, near in zip(queries.tolist(), index.tolist(), cosine.tolist(), strict=True):
                evidence[q] = [{"doc_id": int(self.example["doc_id"][i]), "cosine": c,
                                "toxic": float(self.example["toxic"][i] / self.example["copies"][i])}
                               for i, c in zip(ids, near, strict=True) if i >= 0]
        return score, evidence


def isotonic(vote: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing least-squares fit (pool adjacent violators)."""
    order = np.argsort(vote, kind="stable")
    pools: list[list[float]] = []  # sum of labels, size, first vote, last vote
    for v, y in zip(vote[order].tolist(), label[order].tolist(), strict=True):
        pools.append([y, 1, v, v])
        while len(pools) > 1 and (pools[-2][3] == pools[-1][2] or
                                  pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]):
            y2, n2, _, last = pools.pop()
            pools[-1][0] += y2
            pools[-1][1] += n2
            pools[-1][3] = last
    x = [p[i] for p in pools for i in (2, 3)]
    y = [p[0] / p[1] for p in pools for _ in range(2)]
    return np.array(x), np.array(y)


def training_sample(documents: DataFrame, labels: DataFrame, label: str = "toxic",
                    max_examples: int = MAX_EXAMPLES) -> DataFrame:
    """(doc_id, text, y): labelled training rows, about ``max_examples`` of them, chosen by hash of the id."""
    known = labels.where(f"{label} is not null and doc_id is not null") \
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")) \
        .groupBy("doc_id").agg(F.max("y").alias("y")).where(~held_out(F.col("doc_id")))
    n = known.count()
    share = min(1.0, max_examples / max(n, 1))
    bound = min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))  # of the whole 64 bits: right for any number of labels
    chosen = F.broadcast(known.where(F.xxhash64(F.col("doc_id"), F.lit(5)) <= bound))  # about max_examples rows of 12 bytes
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(chosen, "doc_id") \
        .where("text is not null").dropDuplicates(["doc_id"])


def _families(batches):
    """(doc_id, y) of each text with two min-hashes of its words."""
    release()
    for batch in batches:
        if not batch.num_rows:
            continue
        first, second = [], []
        for chunk in chunks(batch.column(1), limit=TEXT_BYTES):
            found = words(chunk, NOT_ALNUM)
            h = SpanHasher(chunk)(found.starts, found.ends)
            for out, salt in ((first, 3), (second, 9)):
                low = np.zeros(len(chunk), dtype=U64)
                some = found.counts() > 0
                if some.any():
                    low[some] = np.minimum.reduceat(mix(h ^ U64(salt)), found.first[:-1][some])
                out.append(low.view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.concatenate(first)),
                                          pa.array(np.concatenate(second))], names=["doc_id", "y", "m1", "m2"])


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Learn terms, weights, index and calibration."""
    spark = documents.sparkSession
    sample = training_sample(documents, labels, label).select("doc_id", "text", "y")
    sample = stored(sample)  # about MAX_EXAMPLES rows
    firsts = sample.mapInArrow(_families, "doc_id long, y int, m1 long, m2 long").groupBy("m1", "m2", "y").agg(F.min("doc_id").alias("doc_id"))
    sample = sample.join(F.broadcast(firsts.select("doc_id")), "doc_id", "left_semi")  # ids of at most the sample's rows
    totals = sample.agg(F.count("*"), F.sum("y")).first()
    n, n_toxic = totals[0], int(totals[1] or 0)
    model = Model(prior=n_toxic / n if n else 0.0)
    model.empty_rate = model.prior
    if not n_toxic or n_toxic == n:
        return model

    def term_counts(batches):
        for batch in batches:
            y = np.asarray(batch.column(1).cast(pa.int64()))
            lo = 0
            for values, owners, size in _terms(batch.column(0)):
                values, owners, _, base = _counted(values, owners)
                order = np.argsort(values, kind="stable")
                values, label_of, base = values[order], y[lo:lo + size][owners[order]], base[order]
                lo += size
                unique, start = np.unique(values, return_index=True)
                if len(unique):
                    count = np.diff(np.append(start, len(values)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(unique.view(np.int64)), pa.array(base[start].view(np.int64)),
                         pa.array(np.add.reduceat(label_of, start)), pa.array(count)],
                        names=["term", "base", "toxic", "n"])

    counts = sample.select("text", "y").mapInArrow(term_counts, "term long, base long, toxic long, n long") \
        .groupBy("term", "base").agg(F.sum("toxic").alias("a"), F.sum("n").alias("ab")).where(F.col("ab") >= MIN_DOCS)

    def part(observed, expected):
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    a, b = F.col("a"), F.col("ab") - F.col("a")
    c, d = n_toxic - a, (n - n_toxic) - b
    evidence = 2 * sum(part(x, e) for x, e in (
        (a, F.col("ab") * n_toxic / n), (b, F.col("ab") * (n - n_toxic) / n),
        (c, (n - F.col("ab")) * n_toxic / n), (d, (n - F.col("ab")) * (n - n_toxic) / n)))
    best = counts.withColumn("evidence", evidence) \
        .where((F.col("evidence") >= MIN_EVIDENCE) & (a * n >= 2 * n_toxic * F.col("ab"))) \
        .select("term", "base").collect()  # bounded by the sample's terms
    model.terms = np.sort(np.array([r[0] for r in best], dtype=np.int64).view(U64))
    if not len(model.terms):
        return model
    model.bases = np.unique(np.array([r[1] for r in best], dtype=np.int64).view(U64))
    model.gate = np.zeros(1 << 16, dtype=bool)
    model.gate[(model.bases & U64(0xFFFF)).astype(np.int64)] = True

    found = spark.sparkContext.broadcast(model)

    def document_frequencies(batches):
        release()
        n_terms = len(found.value.terms)
        df = np.zeros(n_terms + 1, dtype=np.int64)
        for batch in batches:
            for values, owners, size in _terms(batch.column(0)):
                df[:-1] += np.bincount(found.value.select(values, owners)[0], minlength=n_terms)
                df[-1] += size
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(df))), pa.array(df)], names=["i", "df"])

    df = np.zeros(len(model.terms) + 1)
    for i, total in documents.select("text").mapInArrow(document_frequencies, "i long, df long") \
            .groupBy("i").agg(F.sum("df")).collect():
        df[i] = total
    model.idf = np.log((1 + df[-1]) / (1 + df[:-1])).astype(np.float32) + np.float32(1)

    shared = spark.sparkContext.broadcast(model)

    def example_vectors(batches):
        for batch in batches:
            lo = 0
            for values, owners, size in _terms(batch.column(2)):
                text, term, weight = shared.value.vectors(values, owners, size)
                edges = np.searchsorted(text, np.arange(size + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, size), batch.column(1).slice(lo, size),
                     pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(term)),
                     pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(weight))],
                    names=["doc_id", "y", "terms", "weights"])
                lo += size

    rows = sample.select("doc_id", "y", "text").mapInArrow(
        example_vectors, "doc_id long, y int, terms array<long>, weights array<float>").collect()  # MAX_EXAMPLES rows
    empty = [r["y"] for r in rows if not r["terms"]]
    model.empty_rate = (sum(empty) + model.prior) / (len(empty) + 1)
    distinct: dict[tuple, list[int]] = {}
    for r in sorted((r for r in rows if r["terms"]), key=lambda r: r["doc_id"]):
        entry = distinct.setdefault((tuple(r["terms"]), tuple(r["weights"])), [r["doc_id"], 0, 0])
        entry[1] += 1
        entry[2] += r["y"]
    # similar examples side by side: by their terms in falling weight
    ordered = sorted(distinct.items(), key=lambda e: [t for _, t in sorted(zip(e[0][1], e[0][0], strict=True), reverse=True)])
    model.example = np.array([tuple(v) for _, v in ordered],
                             dtype=[("doc_id", np.int64), ("copies", np.int64), ("toxic", np.int64)])
    sizes = [len(k[0]) for k, _ in ordered]
    model.entries = (np.repeat(np.arange(len(ordered)), sizes).astype(np.int64),
                     np.array([t for k, _ in ordered for t in k[0]], dtype=np.int64),
                     np.array([w for k, _ in ordered for w in k[1]], dtype=np.float32))
    if len(ordered):
        number = {k: i for i, (k, _) in enumerate(ordered)}
        own = [(number[tuple(r["terms"]), tuple(r["weights"])], r["y"]) for r in rows if r["terms"]]
        own_number, own_label = (np.array(x) for x in zip(*sorted(own), strict=True))
        _, index, cosine = model.nearest(*model.entries)
        vote = model.votes(index[own_number], cosine[own_number], (own_number, own_label))
        model.knots = isotonic(vote, own_label.astype(float))
        model._index = None
    return model


EVIDENCE_TYPE = T.ArrayType(T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("cosine", T.DoubleType()),
                                          T.StructField("toxic", T.DoubleType())]))
EVIDENCE_ARROW = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.float64())]))


def with_scores(documents: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows with their score (0 to 1) and evidence (nearest examples, their cosine and label share)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in documents.schema.fields if f.name not in (SCORE, EVIDENCE)]
    names = [f.name for f in kept]

    def score(batches):
        release()
        for batch in batches:
            if not batch.num_rows:
                continue
            at = [batch.schema.get_field_index(c) for c in names]
            scores, evidence = [], []
            for values, owners, size in _terms(batch.column(batch.schema.get_field_index(text_col))):
                s, e = shared.value.scores(values, owners, size)
                scores.append(s)
                evidence.extend(e)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in at), pa.array(np.clip(np.concatenate(scores), 0, 1)),
                 pa.array(evidence, EVIDENCE_ARROW)],
                schema=pa.schema([*(batch.schema.field(i) for i in at), ("__score", pa.float64()),
                                  (EVIDENCE, EVIDENCE_ARROW)]))

    return documents.select(*[f"`{c}`" for c in names]).mapInArrow(score, T.StructType(
        [*kept, T.StructField(SCORE, T.DoubleType()), T.StructField(EVIDENCE, EVIDENCE_TYPE)]))


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document row: doc_id, held_out, score, predicted, evidence."""
    scored = with_scores(documents.select("doc_id", "text"), fit(documents, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(SCORE).alias("score"),
                         (F.col(SCORE) >= 0.5).cast("int").alias("predicted"), F.col(EVIDENCE).alias("evidence"))


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, all columns kept: the rows go through once, nothing is joined or
    stored."""
    shared = documents.sparkSession.sparkContext.broadcast(fit(documents, labels))
    at = documents.columns.index("text")

    def keep(batches):
        release()
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(lo, BATCH_ROWS)
                scores = [shared.value.score_only(*chunk) for chunk in _terms(part.column(at))]
                yield part.filter(pa.array(np.concatenate(scores) < 0.5))

    return documents.mapInArrow(keep, documents.schema)
