import random
import re

import pytest

from tallyloom.llm.decontamination import contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(documents, items, window=13):
    windows = {}
    for item, text in items:
        words = WORD.findall((text or "").translate(LOW))
        size = min(window, len(words))
        for i in range(len(words) - size + 1) if size else ():
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    out = []
    for doc, text in documents:
        words = WORD.findall((text or "").translate(LOW))
        hit, ids = set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                found = windows.get(tuple(words[i : i + size]))
                if found:
                    hit |= set(range(i, i + size))
                    ids |= found
        out.append((doc, len(words), len(hit), sorted(str(i) for i in ids if i is not None)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, docs, prose, odd, seed):
    rng = random.Random(seed)
    items = [(i, prose(seed * 100 + i, rng.choice((3, 12, 13, 14, 40)))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "!!"), (53, "One two"), (0, items[0][1]), (None, items[1][1])]
    items += [(60, "the " * 30), (61, items[4][1]), (62, "UPPER case é " + items[5][1])]
    rows = list(odd) + [(1, "the " * 40), (2, "one TWO three"), (3, "a b c " * 2000 + items[4][1])]
    for d in range(10, 40):
        part = rng.choice(items)[1] or ""
        cut = part.split()[rng.randint(0, 3) :]
        rows.append((d, prose(d, rng.randint(0, 60)) + ", " + "; ".join(cut).upper() + ". " + prose(d + 1, 20)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = contamination(docs(rows), bench)
    got = sorted(
        [(r.doc_id, r.n_words, r.n_hit, list(r.item_ids)) for r in found.collect()], key=repr
    )
    assert got == brute(rows, items)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in contamination(docs([(1, "a b c")]), none).collect()] == [0]
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert contamination(docs([]), some).count() == 0


def test_clashing_columns_are_ignored(spark):
    rows = spark.createDataFrame([(1, "a b c", 5, 6)], "doc_id long, text string, n_words int, row_key int")
    items = spark.createDataFrame([(7, "a b c", 1)], "item_id long, text string, size int")
    row = contamination(rows, items).first()
    assert (row.n_words, row.n_hit, row.item_ids) == (3, 3, ["7"])
