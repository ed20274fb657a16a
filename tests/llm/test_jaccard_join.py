import random
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
from conftest import SF

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
from credence.llm import counters, jaccard_join, queries  # noqa: E402

SCHEMA = ("doc_id long, text string, lang string, node long, n string, size string, a string, "
          "token string, part string")
EXTRA = (1, "n", None, "a", "t", "p")


def classes(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "en", *EXTRA) for i, t in rows], SCHEMA)
    return jaccard_join.jaccard_classes(df, **options).collect()


def agree(spark, docs, shingle=3, percent=90):
    found = classes(spark, list(docs.items()), shingle=shingle, percent=percent)
    expected = brute.near(docs, shingle, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    return len({c for _, c in expected.values()})


def edited(rng, words, edits):
    words = list(words)
    for k in rng.sample(range(len(words)), edits):
        words[k] = f"e{rng.randint(0, 10 ** 6)}"
    return words


def test_given_table_against_all_pairs(spark):
    docs = {r.doc_id: r.text for r in queries.documents(spark, SF).collect()}
    found = queries.op11_jaccard_join(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.near(docs, 3, 90)


def test_groups_chains_and_templates(spark, monkeypatch):
    """Copies with few edits, many linked through others only; chains whose neighbours overlap by
    exactly nine tenths, or just miss it; long shared passages below the threshold."""
    for name, value in (("COUNTERS", counters.PART), ("BLOCK", 16), ("FAMILY", 4)):
        monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(13)
    docs = {}
    for base in range(3):
        words = [f"w{rng.randint(0, 9999)}" for _ in range(90 + 3 * base)]
        second = edited(rng, words, 2)
        for _ in range(110):
            made = edited(rng, rng.choice([words, second]), rng.choice([0, 1, 1, 2, 2, 3]))
            docs[900 - len(docs)] = " ".join(made[:len(made) - rng.choice([0, 0, 1, 4])])
    for i in range(30):
        docs[1000 + i] = " ".join(f"c{k}" for k in range(i, i + 21))  # 18 of 20 shared
        docs[1100 + i] = " ".join(f"d{k}" for k in range(i, i + 20))  # 17 of 19
    shared = [f"s{k}" for k in range(80)]
    for i in range(60):
        docs[1200 + i] = " ".join(shared + [f"u{i}-{k}" for k in range(rng.choice([2, 4, 8, 12]))])
    assert 40 < agree(spark, docs) < 350


def test_other_parameters(spark):
    rng = random.Random(2)
    bases = [[f"w{rng.randint(0, 300)}" for _ in range(30)] for _ in range(8)]
    docs = {i: " ".join(edited(rng, rng.choice(bases), rng.randint(0, 6))) for i in range(150)}
    agree(spark, docs, 2, 75)


def test_edges(spark):
    text = "a fine text of some words that is found more than once"
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, text),
            (8, text.upper()), (9, "unlike anything else here"), (9, text), (None, text),
            (10, "x" * 200_000 + " y z"), (11, "long " * 60_000), (12, "long " * 5), (12, None)]
    found = sorted(map(tuple, classes(spark, rows)), key=str)
    assert found == sorted([
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 10, 7), (8, 10, 7),
        (9, 2, 7), (9, 10, 7), (None, 10, None), (10, 1, 10), (11, 1, 11), (12, 1, 11),
        (12, 0, 12)], key=str)
    assert classes(spark, []) == []


def test_walk_holds_lists_over_batches():
    """Pairs and long lists are the same however the entries are cut into batches."""
    rng = np.random.default_rng(2)
    entries = sorted({(int(t), int(10 + n % 2), int(n % 3), int(n)) for t, n in zip(
        rng.integers(0, 12, 400) ** 2 // 9, rng.integers(0, 60, 400))})
    entries = sorted(entries + entries[::7])

    class Rows:  # the walk as a task sees it
        def repartition(self, *_):
            return self

        def sortWithinPartitions(self, *_):
            return self

        def mapInArrow(self, walk, schema):
            return walk

    def cut(size):
        parts = [entries[i:i + size] for i in range(0, len(entries), size)]
        for part in parts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*part)], ["token", "size", "pos", "node"])

    results = []
    for size in (1, 2, 5, 33, 1000):
        rows = pa.Table.from_batches(list(jaccard_join.walked(Rows(), 90)(cut(size)))).to_pylist()
        results.append(sorted(map(str, rows)))
    assert all(r == results[0] for r in results)
    lists = {}
    for token, _, _, node in set(entries):
        lists.setdefault(token, set()).add(node)
    long_ = sorted((t, n) for t, nodes in lists.items() if len(nodes) > jaccard_join.REACH + 1
                   for n in nodes)
    assert sorted((r["token"], r["node"]) for r in rows if r["token"] is not None) == long_


def test_large_group_forms_few_pairs(spark, monkeypatch):
    """Near copies that nearly all link become one class before pairs of classes are formed."""
    formed, derived = [], jaccard_join.derived

    def counted(asked, sets, percent):
        formed.append(asked.count())
        return derived(asked, sets, percent)

    monkeypatch.setattr(jaccard_join, "derived", counted)
    rng = random.Random(5)
    words = [f"w{k}" for k in range(200)]
    docs = {i: " ".join(edited(rng, words, rng.choice([1, 2, 3]))) for i in range(160)}
    agree(spark, docs)
    assert sum(formed) <= 2 * len(docs)
