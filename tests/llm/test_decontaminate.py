"""Wu-Manber search against a word-by-word scan."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import decontaminate
from tidemark.llm.queries import op1_decontamination
from tests.conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=13):
    patterns = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            patterns.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    sizes = sorted({len(p) for p in patterns})
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                ids = patterns.get(tuple(w[i:i + n]))
                if ids:
                    hit.update(range(i, i + n))
                    found |= ids
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return [tuple(r) for r in decontaminate.contamination(d, b).drop("hit_spans", "item_ids").collect()]


PASSAGE = " ".join(f"w{i}" for i in range(30))


def test_edge_cases(spark):
    items = [(1, PASSAGE), (2, "Short ITEM here"), (3, ""), (4, None), (None, "lost words"), (5, "one"), (5, "one"),
             (6, "ÉTÉ été " + PASSAGE)]
    docs = [(1, None), (2, ""), (3, "..!!"), (4, PASSAGE.upper()), (5, "a short, item;here b"), (6, "x " * 40 + PASSAGE),
            (6, "x " * 40 + PASSAGE), (None, "one"), (7, "y " * 3000 + " ".join(f"w{i}" for i in range(13))),
            (8, " ".join(f"w{i}" for i in range(12))), (9, "one " * 500), (10, "lost words")]
    assert sorted(run(spark, docs, items), key=str) == sorted(brute(docs, [i for i in items if i[0] is not None]), key=str)


def test_empty_tables(spark):
    assert run(spark, [], [(1, PASSAGE)]) == []
    assert run(spark, [(1, PASSAGE)], [])[0][1:4] == (30, 0, 0)


def test_extra_columns_and_shards(spark):
    docs = spark.createDataFrame([(1, "z", PASSAGE, 3), (2, "z", "clean text", 4)], "doc_id long, n_words string, text string, TEXT2 int")
    items = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i, i + 14))) for i in range(10)], "item_id long, text string")
    one = decontaminate.with_occurrences(docs, items).collect()
    many = decontaminate.with_occurrences(docs, items, shard_words=20).collect()
    assert one == many
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=8), min_size=1, max_size=6),
       st.lists(st.sampled_from("abc"), max_size=60))
def test_machines_find_every_occurrence(items, text):
    import pyarrow as pa

    tools = decontaminate.machines([(str(i), " ".join(w)) for i, w in enumerate(items)], window=4)
    batch = pa.RecordBatch.from_pydict({"t": [" ".join(text)]})
    row = decontaminate._scan_batch(batch, "t", tools, ["t"]).to_pylist()[0]
    expected = brute([(0, " ".join(text))], [(i, " ".join(w)) for i, w in enumerate(items)], window=4)[0]
    assert (row["__n_words"], row["__n_hit"], len(row["__items"])) == expected[1:4]


@pytest.mark.parametrize("sf", [SF])
def test_query_equals_brute_force(spark, sf):
    got = {r[0]: tuple(r) for r in op1_decontamination(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()
    assert got == {r[0]: r for r in brute(docs, items)}
    assert spark.read.parquet(f"{sf}/documents.parquet").where(F.col("text").isNull()).count() + len(got) >= len(docs)
