import random
import re
from collections import Counter

import pytest

from tallyloom.llm.debruijn import remove_repeats


def brute(rows, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = {
            i + j
            for i in range(len(w) - window + 1)
            if seen[tuple(w[i : i + window])] > 1
            for j in range(window)
        }
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("seed", "window", "kmer"), [(1, 35, 15), (2, 6, 3), (3, 4, 1), (4, 5, 5)])
def test_against_brute_force(docs, prose, odd, seed, window, kmer):
    rng = random.Random(seed)
    rows = [r for r in odd if r[0] != 906] + [(906, "long " * 300)]
    passages = [prose(seed * 10 + i, rng.randint(window, 3 * window)).split() for i in range(5)]
    for d in range(40):
        words = prose(seed * 1000 + d, rng.randint(0, 2 * window)).split()
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(passages)
            a = rng.randint(0, window // 2)
            at = rng.randint(0, len(words))
            words[at:at] = passage[a : len(passage) - rng.randint(0, window // 3)]
        rows.append((d, rng.choice((" ", "\n")).join(words)))
    rows += [(100, rows[-1][1]), (101, rows[-2][1]), (101, rows[-2][1])]
    found = remove_repeats(docs(rows), window, kmer)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows, window)


def test_empty_table_and_clashing_columns(spark, docs):
    assert remove_repeats(docs([])).count() == 0
    rows = spark.createDataFrame([(1, "a b", 3, 4)], "doc_id long, text string, row_key int, kept int")
    assert tuple(remove_repeats(rows).first()) == (1, 2, 0, "a b")
