import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import wavelet as wm

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=300), st.sampled_from([1, 4, 1 << 14]))
def test_shard_lookups(tokens, block):
    before, wm.BLOCK = wm.BLOCK, block
    try:
        data = wm.encode_shard(np.array(tokens, np.uint32), [5, None], [len(tokens), 0])
    finally:
        wm.BLOCK = before
    shard = wm.Shard(data)
    assert shard.tokens.tolist() == tokens
    assert shard.doc_ids == [5, None] and shard.lengths.tolist() == [len(tokens), 0]
    assert [shard.access(i) for i in range(len(tokens))] == tokens
    for token in set(tokens[:20]) | {3, 80_000, 1 << 20}:
        places = [i for i, t in enumerate(tokens) if t == token]
        assert shard.count(token) == len(places)
        assert [shard.select(token, k) for k in range(len(places))] == places
        assert shard.rank(token, len(tokens) // 2) == sum(p < len(tokens) // 2 for p in places)
        with pytest.raises(IndexError):
            shard.select(token, len(places))
    with pytest.raises(IndexError):
        shard.access(len(tokens))


def plain():
    return tokenizers.Tokenizer.from_file(wm.tokenizer_path())


TEXT = st.text(alphabet="ab'S \n\t\r\x0b\x1c\x85  é1_-.<|endoftext|>", max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=5))
def test_pieces_give_the_tokenizer_s_ids(texts):
    check(ENCODERS[0], texts)


def check(encoder, texts):
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    expected = [plain_.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]
    assert ids.tolist() == [i for e in expected for i in e]
    assert counts.tolist() == [len(e) for e in expected]


@pytest.mark.parametrize("size", [1, 2, 5])
def test_added_tokens_in_texts(size, prose):
    word = "<|endoftext|>"
    texts = [f"a {word} b", word, f"{word}{word}", None, "", "<|endof", "text|>", f" {word}\n", f"é{word}", prose(1, 30) + word, f"<|{word}|>"]
    for a in range(0, len(texts), size):
        check(ENCODERS[0], texts[a : a + size])


ENCODERS = [wm.Encoder(wm.tokenizer_path())]
ENCODERS[0].KNOWN, ENCODERS[0].TABLE = 3000, 4  # forget often, find few pieces without a search
ENCODERS[0]._forget()


def test_misleading_hashes(monkeypatch, prose):
    texts = [prose(i, 50) + "\nand  more" for i in range(6)] + [None, "", " "]
    monkeypatch.setattr(wm.bw, "hash_words", lambda w: (w.ends - w.starts).astype(np.uint64))
    encoder = wm.Encoder(wm.tokenizer_path())
    for _ in range(2):
        check(encoder, texts)
    monkeypatch.undo()
    check(encoder, texts)


def test_other_vocabularies_are_asked_piece_by_piece(prose):
    encoder = wm.Encoder(wm.tokenizer_path())
    encoder.lengths = encoder.lengths + 1
    check(encoder, [prose(1, 300), None])


plain_ = plain()


def test_files_round_trip(spark, docs, odd, prose, tmp_path):
    rows = list(odd) + [(i * 7 % 50, prose(i, i)) for i in range(50)]
    path = str(tmp_path / "shards")
    wm.write_shards(docs(rows), path, wm.tokenizer_path(), shard_tokens=100)
    assert spark.read.parquet(path).count() > 10
    found = sorted(wm.read_documents(spark, path, ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((r[0] for r in rows), key=lambda i: -1 if i is None else i)
    start = 0
    texts = {i: sorted((t or "" for d, t in rows if d == i)) for i, _ in rows}
    got = {}
    for r in found:
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.ids[-1] == 0
        got.setdefault(r.doc_id, []).append(plain_.decode(r.ids[:-1], skip_special_tokens=False))
        start += r.n_tokens
    assert {i: sorted(t) for i, t in got.items()} == texts


def test_empty_table(spark, docs, tmp_path):
    path = str(tmp_path / "none")
    wm.write_shards(docs([]), path, wm.tokenizer_path())
    assert wm.read_documents(spark, path).count() == 0
