import random
import re
from collections import Counter

import numpy as np
import pytest

from credence.llm import collocations, counters
from credence.llm.text_kernel import word_hashes as plain_hashes

SCHEMA = ("doc_id long, text string, lang string, source string, f long, k string, ids string, "
          "code string, word string")
EXTRA = ("s", 1, "k", None, "c", "w")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, longest, least, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    often = {p: c for p, c in f.items() if c >= least}
    covered = Counter()
    for (lang, p), c in often.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                covered[lang, p[i:i + k]] = max(covered[lang, p[i:i + k]], c)
    out = []
    for (lang, p), a in often.items():
        if len(p) > 1 and covered[lang, p] < a:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k)
                    for k in range(1, len(p))]
            score, k = min(cuts)
            out.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    ranked, seen = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return ranked


def edge_texts():
    rng = random.Random(8)
    words = ["of", "The", "the", "é", "ß", "Σ", "a\x00b", "\xa0", "😀", "x-y", "'s", "of"]
    rows = []
    for _ in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ". ", "\n", ",", "  "])
                       for _ in range(rng.randint(0, 60)))
        rows.append((text, rng.choice(["en", "fr", "", None])))
    return rows + [(None, "en"), ("", "de"), (" \t\n", None), ("same same " * 3000, "fr"),
                   ("y" * 100_000 + " of the", "en")] + [("one and the same text", "en")] * 12


def as_docs(spark, rows):
    return spark.createDataFrame(
        [(i % 7 or None, t, g, *EXTRA) for i, (t, g) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("longest,least,top,entries", [
    (5, 5, 2000, 400_000), (5, 5, 7, 400_000), (5, 4, 2000, 40), (2, 3, 50, 400_000)])
def test_against_brute_force(spark, longest, least, top, entries, monkeypatch):
    if entries < 1000:  # containers burst and subtrees leave, counters are shared by many phrases
        monkeypatch.setattr(collocations, "CONTAINER_ENTRIES", 3)
        monkeypatch.setattr(collocations, "COUNTERS", counters.PART)
    rows = edge_texts()
    found = collocations.collocations(as_docs(spark, rows), longest, least, top, entries)
    assert sorted(map(tuple, found.collect())) == sorted(brute(rows, longest, least, top))


def test_no_rows_without_frequent_phrases(spark):
    rows = edge_texts()
    assert collocations.collocations(as_docs(spark, rows), least=10 ** 6).collect() == []
    assert collocations.collocations(as_docs(spark, rows).limit(0)).collect() == []


def test_words_that_share_an_id_are_hashed_anew(spark, monkeypatch):
    """A first hash that knows only eight values; the words tell that it fails."""
    def hashes(data, starts, ends, values):
        h = plain_hashes(data, starts, ends, values)
        return h & np.uint64(7) if np.array_equal(values, first) else h

    first = collocations.letters(0)
    monkeypatch.setattr(collocations, "word_hashes", hashes)
    rows = edge_texts()
    with collocations.Workspace(spark) as space:
        words, seed = collocations.counted_words(as_docs(spark, rows), space)
        assert seed == 1 and words.count() == words.select("lang", "word").distinct().count()


def test_trie_gives_what_it_was_given(monkeypatch):
    """Whatever bursts and leaves in between, the runs are sorted and their counts add up."""
    monkeypatch.setattr(collocations, "CONTAINER_ENTRIES", 5)
    rng = random.Random(1)
    trie, expected, given = collocations.HatTrie(300), Counter(), Counter()

    def take(runs):
        for lang, found in runs:
            rows = list(map(tuple, found[:, :-1].tolist()))
            assert rows == sorted(set(rows))
            for row, n in zip(rows, found[:, -1].tolist()):
                given[lang, row] += n

    for _ in range(400):
        k, lang = rng.randint(2, 5), rng.choice(["en", "de"])
        rows = sorted({tuple(rng.choices(range(7), k=k)) for _ in range(rng.randint(1, 60))})
        counts = [rng.randint(1, 9) for _ in rows]
        for row, n in zip(rows, counts):
            expected[lang, row] += n
        trie.add(lang, np.column_stack([rows, counts]).astype(np.uint64))
        take(trie.leaving())
        assert trie.size <= 300 and trie.size == sum(t.size for t in trie.trees.values())
    take(trie.leaving(True))
    assert given == expected and not trie.size and not trie.trees
