import numpy as np
import pyarrow as pa

from tallyloom.llm import language as lg

WORDS = {
    "aa": "kalo mita suno vero lake tima sora".split(),
    "bb": "schtrumpf angst zwerg pflicht kraft".split(),
    "cc": "ñandú peña señor niño caña".split(),
}


def texts(lang, n, seed=0):
    rng = np.random.default_rng(seed)
    return [" ".join(rng.choice(WORDS[lang], 12)) for _ in range(n)]


def test_held_out_accuracy(docs):
    rows = [(i, t, lang) for j, lang in enumerate(WORDS) for i, t in enumerate(texts(lang, 40, j), 100 * j)]
    model = lg.fit(docs(rows))
    assert sorted(set(model.languages)) == ["aa", "bb", "cc"] and len(model.languages) > 3
    new = [(i, t, lang) for j, lang in enumerate(WORDS) for i, t in enumerate(texts(lang, 20, 9 + j), 100 * j)]
    found = {r.doc_id: r for r in lg.identify(docs(new), model).collect()}
    assert all(found[i].lang_pred == lang for i, _, lang in new)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_odd_texts(docs, odd):
    rows = [(i, t, "aa") for i, t in enumerate(texts("aa", 20))] + [(1, None, "bb"), (2, "x", None)]
    found = lg.identify(docs(odd), lg.fit(docs(rows))).collect()
    assert len(found) == len(odd)
    for r in found:
        assert r.lang_pred == ("und" if r.doc_id in (900, 901, 902, 907) else "aa")
        assert r.lang_pred != "und" or (r.score == 0 and r.rejected)


def test_far_texts_are_rejected(docs):
    rows = [(i, t, lang) for lang in WORDS for i, t in enumerate(texts(lang, 30))]
    found = lg.identify(docs([(1, "qqq xxx jjj www"), (2, texts("aa", 1, 5)[0])]), lg.fit(docs(rows)))
    assert {r.doc_id: r.rejected for r in found.collect()} == {1: True, 2: False}


def test_nothing_to_learn_from(docs):
    assert lg.fit(docs([(1, "abc", None)])) is None
    row = lg.identify(docs([(1, "abc", "aa")]), None).first()
    assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
    assert lg.identify(docs([]), None).count() == 0


def test_counts_never_mix_texts(monkeypatch):
    column = pa.array(["ab cd", None, "xy", "ab cd", "long " * 50])
    alone = np.vstack([lg.trigram_counts(pa.array([t], pa.string())) for t in column.to_pylist()])
    assert (lg.trigram_counts(column) == alone).all()
    assert (lg.trigram_counts(column.slice(2)) == alone[2:]).all()
    monkeypatch.setattr(lg.bw, "CHUNK", 7)
    assert (lg.trigram_counts(column) == alone).all()


def test_sample_is_bounded(docs):
    from tallyloom.llm.base import bounded_sample

    rows = [(i, "t", ("aa", "bb")[i % 10 == 0]) for i in range(500)] + [(7, "t", None)]
    found = bounded_sample(docs(rows), "lang", 20).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in found} == {"aa": 20, "bb": 20}
