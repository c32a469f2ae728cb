"""N-gram Jaccard join with a token-group matrix.

Documents are sets of k-word shingles (64-bit hashes).  Two documents link when
``100 * |A and B| >= percent * |A or B|``; the result is the connected component of every document.

1. Equal sets are one set (known by a digest), however many documents have it.
2. A set is cut into segments by the range of the hash.  Linked sets differ in at most
   ``d = (100 - percent) * (|A| + |B|) / (100 + percent)`` shingles, so of more than d segments at least
   one is equal in both.  The segment numbers follow size bands (each set takes part in its own band and
   the one below, because linked sets are in the same or in neighbouring bands).  A segment's hash is the
   *token* of the matrix; a passage that many documents share does not fill whole segments, so it makes no
   candidates.  Where so many segments are empty that the equal one might be empty, the set also emits its
   empty segments; a pair needs that only if both sets are so.
3. Similar sets form groups: same most frequent token, so that a family of near copies falls into few groups;
   large groups are dealt into pieces of about ``GROUP_SETS`` sets and ``GROUP_SHINGLES`` shingles.  The
   distinct rows (token, group) are the token-group matrix.
4. A set is held against a group only if the matrix says so: of its own filled segments at most d differ from
   those of a linked set, so ``filled - d`` of its tokens (one at least) must be in the group's token union.  These
   counts are summed by (set, group) before any set moves, and only where one of the set's rarer tokens is in the union.  Of two groups the sets of the smaller one ask.
   Where a set meets a group that it qualifies for, the group's shingle union bounds the overlap: only if
   ``100 * |Q and union| >= percent * max(|Q|, smallest member)`` the exact overlaps with its members are
   counted.  A group is sent once per ``GROUP_SETS`` asking sets, not once per pair of groups.
5. Rounds, each with the components that the links so far make.  First every group is opened with itself.
   Then, twice, every matrix row proposes one pair of sets between its first component and each other one
   (linear in the number of rows); this joins what belongs together across groups.  Last, the sets ask the
   groups that hold another component in one of their rows.  No pair that could link different components is
   left out, so the result is exact.
6. Shingles are many times larger than tokens, so they move only for sets that the tokens leave: a group is opened
   with the members that share enough tokens with another one of it, a proposed pair is tested if it shares enough.

Defined results: a null or blank text has no shingles, links with nothing and is its own component;
fewer than k words make the whole sequence one shingle; a null doc_id gets the component of its text's
copies, if any has an id; repeated rows each give their row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrowtext import POSITION_CODE, U64, WHITE_SPACE, chunks, mix, shingles, span_hashes, words
from tidemark.llm.components import connected_components
from tidemark.llm.tables import BROADCAST_ROWS, discard, few_files, stored, tidy
from tidemark.llm.token_files import release

TEXT_BYTES = 1 << 20
GROUP_SETS = 1024
GROUP_SHINGLES = 1 << 18
FILE_SETS = 4_096  # sets with shingles or tokens that make one partition of a table whose size is known


def _distinct_sorted(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each range sorted, without repeats."""
    hashes = hashes.copy()
    edges = bounds.tolist()
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        if hi - lo > 1:
            hashes[lo:hi].sort()
    keep = np.ones(len(hashes), dtype=bool)
    keep[1:] = hashes[1:] != hashes[:-1]
    keep[bounds[:-1][np.diff(bounds) > 0]] = True
    total = np.concatenate(([0], np.cumsum(keep)))
    return hashes[keep], total[bounds]


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(sorted distinct shingle hashes, bounds per text) for chunks of whole texts, in order."""
    for chunk in chunks(column, limit=TEXT_BYTES):
        found = words(chunk, WHITE_SPACE)
        yield _distinct_sorted(*shingles(span_hashes(chunk, found.starts, found.ends), found.first, k))


def _digests(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64-bit digest of each set."""
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, U64), np.cumsum(mix(values * POSITION_CODE[7]), dtype=U64)))
        other = np.concatenate((np.zeros(1, U64), np.cumsum(mix(values * POSITION_CODE[8]), dtype=U64)))
        return mix(total[bounds[1:]] - total[bounds[:-1]]) ^ mix(
            (other[bounds[1:]] - other[bounds[:-1]]) * POSITION_CODE[9] + np.diff(bounds).astype(U64))


class Bands:
    """Size bands and the number of segments of each, for one threshold."""

    def __init__(self, percent: int, largest: int = 1 << 40):
        self.percent = percent
        edges = [1]
        while edges[-1] < largest:
            edges.append(max(edges[-1] + 1, 100 * edges[-1] // percent + 1))
        self.edges = np.array(edges, dtype=np.int64)
        top = self.edges[1:] - 1
        self.allowed = (100 - percent) * (top + 100 * top // percent) // (100 + percent)
        self.segments = self.allowed + 1 + -(-self.allowed // 8)

    def tokens(self, values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token, number of its set) for sets without repeats, sorted by hash."""
        n = np.diff(bounds)
        text = np.repeat(np.arange(len(n)), n)
        own = np.searchsorted(self.edges, np.maximum(n, 1), side="right") - 1
        with np.errstate(over="ignore"):
            total = np.concatenate((np.zeros(1, U64), np.cumsum(mix(values + POSITION_CODE[3]), dtype=U64)))
            tokens, owners = [], []
            for band in (own, own - 1):
                segments = np.where(band >= 0, self.segments[band], 0)
                segment = ((values >> U64(32)) * segments[text].astype(U64)) >> U64(32)
                new = np.ones(len(values), dtype=bool)
                new[1:] = (text[1:] != text[:-1]) | (segment[1:] != segment[:-1])
                new &= band[text] >= 0
                start = np.flatnonzero(new)
                end = np.append(start[1:], len(values))
                end = np.minimum(end, bounds[1:][text[start]])
                place = mix(band[text[start]].astype(U64) * POSITION_CODE[4] + segment[start] * POSITION_CODE[5])
                tokens.append(mix((total[end] - total[start]) ^ place))
                owners.append(text[start])
                filled = np.bincount(text[start], minlength=len(n))
                for t in np.flatnonzero((n > 0) & (band >= 0) & (filled <= np.where(band >= 0, self.allowed[band], 0))).tolist():
                    empty = np.setdiff1d(np.arange(segments[t], dtype=U64), segment[bounds[t]:bounds[t + 1]])
                    tokens.append(mix(mix(U64(band[t]) * POSITION_CODE[4] + empty * POSITION_CODE[5])))
                    owners.append(np.full(len(empty), t))
        return np.concatenate(tokens), np.concatenate(owners)


    def needed(self, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Number of its tokens that every set which links with it has at least, for sets as in ``tokens``.

        The bound of step 2 holds with the set's own size and the largest of the other: one of the set's own or the next band
        meets it in its own band, one of the band below, which ends before the set's own, in that."""
        n = np.diff(bounds)
        text = np.repeat(np.arange(len(n)), n)
        own = np.searchsorted(self.edges, np.maximum(n, 1), side="right") - 1
        least = np.full(len(n), np.iinfo(np.int64).max)
        for band, other in ((own, 100 * n // self.percent), (own - 1, self.edges[own] - 1)):
            allowed = np.minimum(self.allowed[band], (100 - self.percent) * (n + other) // (100 + self.percent))
            segment = ((values >> U64(32)) * np.where(band >= 0, self.segments[band], 0)[text].astype(U64)) >> U64(32)
            new = np.ones(len(values), dtype=bool)
            new[1:] = (text[1:] != text[:-1]) | (segment[1:] != segment[:-1])
            filled = np.bincount(text[new], minlength=len(n))
            least = np.where(band >= 0, np.minimum(least, filled - allowed), least)
        return np.maximum(least, 1)


def _clean(work):
    """The work of a task, in a worker that holds nothing of its earlier tasks, and nothing of this one afterwards."""
    def run(batches):
        release()
        yield from work(batches)
        release()
    return run


def _slices(batches, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Few sets at a time, so that only these become Python objects."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def _few(ids: DataFrame) -> DataFrame:
    """Narrow stored rows as a side of a join: sent to the other side if they are few."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def _partners(table: pa.Table) -> pa.Table:
    """(gid, sid) of the sets of one group that share enough tokens with another one of it.

    ``table``: (gid, sid, needed, held), held being the set's tokens."""
    held = table["held"].combine_chunks()
    size, owner = np.asarray(held.value_lengths()), np.asarray(held.value_parent_indices())
    needed = np.asarray(table["needed"])
    _, at, n = np.unique(np.asarray(held.flatten()), return_inverse=True, return_counts=True)
    holders, ends = owner[np.argsort(at, kind="stable")], np.cumsum(n)
    found = np.zeros(len(size), dtype=bool)
    for i, own in enumerate(np.split(at, np.cumsum(size)[:-1])):
        rows = np.repeat(ends[own] - np.cumsum(n[own]), n[own]) + np.arange(int(n[own].sum()))
        same = np.bincount(holders[rows], minlength=len(size))
        same[i] = 0
        found[i] = bool((same >= np.maximum(needed, needed[i])).any())
    return table.select(["gid", "sid"]).filter(pa.array(found))


def _plausible(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets that share as many tokens as either needs. ``held``: (sid, needed, held)."""
    def side(name):
        return held.select(F.col("sid").alias(name), F.col("needed").alias(f"needed_{name}"), F.col("held").alias(f"held_{name}"))

    return pairs.join(side("a"), "a").join(side("b"), "b").where(
        "size(array_intersect(held_a, held_b)) >= greatest(needed_a, needed_b)").select("a", "b")


def _test_pairs(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of sets that link; ``pairs`` are stored."""
    def test(batches):
        for batch in _slices(batches):
            linked = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                small, large = sorted((np.frombuffer(x, dtype=U64), np.frombuffer(y, dtype=U64)), key=len)
                if 100 * len(small) >= percent * len(large) and len(large):
                    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    overlap = int((large[at] == small).sum())
                    linked[i] = 100 * overlap >= percent * (len(small) + len(large) - overlap)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(linked))

    def side(name):
        return members.select(F.col("sid").alias(name), F.col("tokens").alias(f"tokens_{name}"))

    both = side("a").join(_few(pairs), "a").join(side("b").join(_few(pairs.select("b").distinct()), "b", "left_semi"), "b")
    return few_files(both.select("a", "b", "tokens_a", "tokens_b"), pairs.count(), FILE_SETS).mapInArrow(
        _clean(lambda batches: test(x for x in batches if x.num_rows)), "a long, b long")


def document_sets(documents: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, sid): size and digest of each row's set; sid is null for an empty set."""
    def describe(batches):
        for batch in batches:
            if batch.num_rows:
                sizes, ids = [], []
                for values, bounds in shingle_sets(batch.column(1), k):
                    sizes.append(np.diff(bounds))
                    ids.append(_digests(values, bounds))
                size = np.concatenate(sizes).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(size), pa.array(np.concatenate(ids).view(np.int64), mask=size == 0)],
                    names=["doc_id", "n_shingles", "sid"])

    return documents.select("doc_id", "text").mapInArrow(_clean(describe), "doc_id long, n_shingles long, sid long")


def matrix_rows(documents: DataFrame, k: int, percent: int) -> DataFrame:
    """(token, sid) of all sets; a set that repeats within a partition gives its rows once."""
    def rows(batches):
        bands = Bands(percent)
        seen = set()  # a number per different set of this partition
        for batch in batches:
            if not batch.num_rows:
                continue
            for values, bounds in shingle_sets(batch.column(0), k):
                ids = _digests(values, bounds)
                once = np.zeros(len(ids), dtype=bool)
                first = np.unique(ids, return_index=True)[1]
                once[[i for i, sid in zip(first.tolist(), ids[first].tolist(), strict=True) if sid not in seen]] = True
                seen.update(ids[once].tolist())
                token, owner = bands.tokens(values, bounds)
                kept = once[owner]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token[kept].view(np.int64)), pa.array(ids[owner[kept]].view(np.int64))], names=["token", "sid"])

    return documents.select("text").mapInArrow(_clean(rows), "token long, sid long")


def _members(documents: DataFrame, groups: DataFrame, k: int, percent: int) -> DataFrame:
    """(gid, sid, tokens, needed) of every grouped set, its shingles as little-endian 64-bit hashes.

    ``groups``: (gid, sid, rep), rep being a document with this set."""
    def sets(batches):
        bands = Bands(percent)
        for batch in _slices(batches, 1024):
            if not batch.num_rows:
                continue
            found, same, needed = [], [], []
            for values, bounds in shingle_sets(batch.column(2), k):
                needed.append(bands.needed(values, bounds))
                same.append(_digests(values, bounds).view(np.int64))
                found += [values[lo:hi].tobytes() for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            right = pa.array(np.concatenate(same) == np.asarray(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary()),
                                              pa.array(np.concatenate(needed))],
                                             names=["gid", "sid", "tokens", "needed"]).filter(right)

    wanted = F.broadcast(groups) if groups.count() <= BROADCAST_ROWS else groups
    texts = documents.select(F.col("doc_id").alias("rep"), "text").join(wanted, "rep").select("gid", "sid", "text")
    return texts.mapInArrow(_clean(sets), "gid long, sid long, tokens binary, needed long")


def _links(query: list[tuple], group: list[tuple], percent: int, same: bool) -> list[tuple[int, int]]:
    """Spanning links between two groups of (sid, component, tokens); components differ already."""
    leader = {r: r if c is None else c for r, c, _ in query + group}
    parent = {c: c for c in leader.values()}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sets = [np.frombuffer(t, dtype=U64) for _, _, t in group]
    size = np.array([len(s) for s in sets], dtype=np.int64)
    tokens = np.concatenate(sets)
    member = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(tokens, kind="stable")
    union, starts = np.unique(tokens[order], return_index=True)
    member, bounds = member[order], np.append(starts, len(tokens))
    smallest = int(size.min())
    out = []
    for i, (rep, _, raw) in enumerate(query):
        q = np.frombuffer(raw, dtype=U64)
        at = np.minimum(np.searchsorted(union, q), len(union) - 1)
        at = at[union[at] == q]
        if 100 * len(at) < percent * max(len(q), smallest):
            continue  # the union bounds the overlap with every member
        if len({find(leader[r]) for r, _, _ in group} | {find(leader[rep])}) == 1:
            continue
        n = bounds[at + 1] - bounds[at]
        rows = np.repeat(bounds[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        overlap = np.bincount(member[rows], minlength=len(sets))
        linked = np.flatnonzero(100 * overlap >= percent * (len(q) + size - overlap))
        for j in linked.tolist():
            if same and j <= i:
                continue
            a, b = find(leader[rep]), find(leader[group[j][0]])
            if a != b:
                parent[a] = b
                out.append((rep, group[j][0]))
    return out


def _open(rows: DataFrame, n_rows: int, percent: int) -> DataFrame:
    """Links (a, b) between the members (side 0) and the asking sets (side 1) of every (gid, piece); a group
    without asking sets is opened with itself.

    ``rows``: ``n_rows`` of (gid, piece, side, sid, component or null, tokens)."""
    def search(batches):
        def links(rows):
            sides = [[r[1:] for r in rows if r[0] == s] for s in (0, 1)]
            same = not sides[1]
            return _links(sides[0] if same else sides[1], sides[0], percent, same) if sides[0] else []

        key, rows = None, []
        for batch in _slices(batches):
            found = []
            for gid, piece, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (gid, piece) != key:
                    found.extend(links(rows))
                    key, rows = (gid, piece), []
                rows.append(row)
            if found:
                yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in found], schema=EDGE)
        if rows and (found := links(rows)):
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in found], schema=EDGE)

    dealt = rows.select("gid", "piece", "side", "sid", "component", "tokens").repartition("gid", "piece")
    return few_files(dealt, n_rows, FILE_SETS).sortWithinPartitions("gid", "piece", "side", "sid").mapInArrow(_clean(search), "a long, b long")


def _ask(queries: DataFrame, n_sets: int, placed: DataFrame, members: DataFrame, percent: int, group_sets: int, group_shingles: int) -> DataFrame:
    """Links (a, b) of the sets in ``queries`` (gid, sid) with the members of the groups they ask.

    The asking sets of a group are dealt into pieces of bounded size, each with its copy of the group; shingles
    are joined to these places last.  ``placed``: ``n_sets`` of (sid, gid, component); ``members``: (sid, tokens)."""
    sized = queries.join(members.select("sid", F.length("tokens").alias("bytes")), "sid")
    pieces = sized.groupBy("gid").agg(F.greatest(
        F.ceil(F.count("*") / group_sets), F.ceil(F.sum("bytes") / (8 * group_shingles))).alias("pieces"))
    asking = queries.join(pieces, "gid").select(
        "gid", F.pmod(F.xxhash64("sid"), F.col("pieces")).alias("piece"), F.lit(1).alias("side"), "sid") \
        .join(placed.select("sid", "component"), "sid")
    asked = placed.select("gid", "sid", "component").join(pieces, "gid") \
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))).withColumn("side", F.lit(0))
    # a group of at most ``group_sets`` sets goes once to as many asking sets, so about two rows a query and one a set
    places = stored(few_files(asking.unionByName(asked.select(*asking.columns)), 2 * queries.count() + n_sets))
    links = stored(_open(members.select("sid", "tokens").join(_few(places), "sid"), places.count(), percent))
    discard(places)
    return links


def _asks(shared: DataFrame, n_shared: int, placed: DataFrame, needed: DataFrame) -> DataFrame:
    """(gid, sid): the sets that must be held against a group, by the rows of the token-group matrix alone.

    ``shared``: ``n_shared`` of (token, sid); ``placed``: (sid, gid, size of the group, component); ``needed``: (sid, needed)."""
    held = shared.join(placed, "sid")
    mixed = held.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")) \
        .where("lo != hi").select("token")
    mixed = stored(few_files(held.join(mixed, "token"), n_shared))
    # of the tokens that a set shares with a group, one at least is not among those ``needed - 1`` that most groups hold:
    # these are not joined, but looked up where a group has one of the others
    often = mixed.groupBy("token").agg(F.countDistinct("gid").alias("groups"))
    ranked = mixed.join(often, "token").join(needed, "sid").withColumn(
        "rank", F.row_number().over(Window.partitionBy("sid").orderBy(F.desc("groups"), "token")))
    rare = ranked.where("rank >= needed")
    common = ranked.where("rank < needed").groupBy("sid").agg(F.collect_list("token").alias("common"))
    matrix = mixed.groupBy("token", "gid", "size").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    unions = matrix.join(ranked.where("rank < needed").select("token").distinct(), "token") \
        .groupBy("gid").agg(F.collect_list("token").alias("union"))
    counts = rare.alias("x").join(matrix.alias("y"), F.expr(
        "x.token = y.token and (x.size < y.size or x.size = y.size and x.gid < y.gid)"
        " and (x.component != y.lo or x.component != y.hi)")) \
        .groupBy(F.col("x.sid").alias("sid"), F.col("y.gid").alias("gid")).agg(F.count("*").alias("n"))
    counts = counts.join(needed, "sid").join(common, "sid", "left").join(unions, "gid", "left")
    asks = stored(counts.where("n + coalesce(size(array_intersect(common, union)), 0) >= needed").select("gid", "sid"))
    discard(mixed)
    return asks


EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _proposals(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b): for every token, the first set of its first component with that of each other component."""
    held = shared.join(labels, "sid", "left").withColumn("component", F.coalesce("component", "sid")) \
        .groupBy("token", "component").agg(F.min("sid").alias("b"))
    first = held.groupBy("token").agg(F.min(F.struct("component", "b")).alias("p"))
    return held.join(first, "token").where("component != p.component").select(F.col("p.b").alias("a"), "b").distinct()


def jaccard_components(documents: DataFrame, k: int = 5, percent: int = 80,
                       group_sets: int = GROUP_SETS, group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """One row per document row: doc_id, n_shingles, component_id."""
    spark = documents.sparkSession
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = stored(document_sets(documents, k))
    owners = sets.where("sid is not null and doc_id is not null").groupBy("sid").agg(
        F.min("doc_id").alias("rep"), F.any_value("n_shingles").alias("n"))

    rows = matrix_rows(documents, k, percent).repartition("token")
    several = rows.groupBy("token").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi")).where("lo != hi").select("token")
    shared = stored(rows.join(several, "token").distinct())
    tidy(spark)  # after each of the large steps, else their shuffles stay until the end
    often = shared.groupBy("token").agg(F.count("*").alias("often"))
    keys = shared.join(often, "token").groupBy("sid").agg(F.max(F.struct("often", "token")).alias("top")) \
        .join(owners, "sid").withColumn("key", F.col("top.token"))
    pieces = keys.groupBy("key").agg(F.greatest(F.ceil(F.count("*") / group_sets), F.ceil(F.sum("n") / group_shingles)).alias("pieces"))
    groups = stored(few_files(keys.join(pieces, "key").select(
        "sid", "rep", F.xxhash64("key", F.pmod(F.xxhash64("sid"), F.col("pieces"))).alias("gid")), sets.count()))
    n_sets, n_shared = groups.count(), shared.count()
    members = stored(_members(documents, groups, k, percent))
    if members.count() > n_sets:  # rows repeat the id of a set's document
        repeated, members = members, stored(members.dropDuplicates(["sid"]))
        discard(repeated)
    tidy(spark)

    sizes = groups.groupBy("gid").agg(F.count("*").alias("size"))
    held = stored(few_files(shared.groupBy("sid").agg(F.collect_list("token").alias("held")).join(
        members.select("sid", "needed"), "sid"), n_sets, FILE_SETS))
    several = groups.select("gid", "sid").join(sizes.where("size > 1"), "gid").select("gid", "sid")
    opened = stored(few_files(several.join(held, "sid").select("gid", "sid", "needed", "held").groupBy("gid").applyInArrow(
        _partners, "gid long, sid long"), n_sets, FILE_SETS))
    tidy(spark)
    own = members.select("sid", "tokens").join(_few(opened), "sid").select(
        "gid", F.lit(0).alias("piece"), F.lit(0).alias("side"), "sid", F.lit(None).cast("long").alias("component"), "tokens")
    found = [stored(_open(own, opened.count(), percent))]
    tidy(spark)
    parts = [connected_components(found[0])]
    labels = parts[0].withColumnRenamed("node", "sid")
    for _ in range(2):
        pairs = stored(few_files(_plausible(_proposals(shared, labels), held), n_shared))
        tidy(spark)
        found.append(stored(_test_pairs(pairs, members, percent)))
        discard(pairs)
        links = found[0].unionByName(found[1]) if len(found) == 2 else found[0].unionByName(found[1]).unionByName(found[2])
        parts.append(connected_components(links))
        labels = parts[-1].withColumnRenamed("node", "sid")
        tidy(spark)

    placed = stored(few_files(groups.join(sizes, "gid").join(labels, "sid", "left").select(
        "sid", "gid", "size", F.coalesce("component", "sid").alias("component")), n_sets))
    asks = _asks(shared, n_shared, placed, members.select("sid", "needed"))
    tidy(spark)
    more = _ask(asks, n_sets, placed, members, percent, group_sets, group_shingles)
    tidy(spark)
    component = connected_components(links.unionByName(more)).withColumnRenamed("node", "sid")
    discard(shared, groups, members, held, opened, placed, asks, more, *found, *parts)

    # the smallest document of each component
    owner = owners.join(component, "sid", "left").select("sid", "rep", F.coalesce("component", "sid").alias("component"))
    smallest = owner.groupBy("component").agg(F.min("rep").alias("component_id"))
    known = owner.join(smallest, "component").select("sid", "component_id")
    return sets.join(known, "sid", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
