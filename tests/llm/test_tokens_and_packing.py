import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from asklens.llm import packing, queries, token_output
from asklens.llm.tokens import ChunkEncoder
from asklens.session import scratch_path

ODD = ["'s", "it's a 'sd test", "a  b", "a\n b", "a \n\n b", " lead", "trail ", "x <|endoftext|> y", "<|endoftext|>", "é́ a ́b",
       "Ünï ß ΑΣ Σ ΑΣ. x", "12 3.14 2a", "a\n\nb c", "a\n.b", "İstanbul I", "ﬁ ½ ² 漢字 漢 한", "\t a\tb", "🙂 🙂a b🙂", "a\rb c\x0bd",
       " ", "  ", "\n", "", "foo\n bar", "x-\ny", "DON'T can't 'LL", " x   y", "a\x85b \x85"]


@pytest.mark.parametrize("file", ["word_file", "byte_file"])
def test_cached_ids_are_the_librarys(file, request, docs):
    encoder = ChunkEncoder(request.getfixturevalue(file))
    texts = ODD + [r["text"] for r in docs.collect()]
    assert [encoder.encode(t) for t in texts] == encoder.encode_whole(texts)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t.,'aAbéßΣ1²́ "), st.characters(codec="utf-8")), max_size=30))
def test_cached_ids_of_any_text(text):
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        encoder = ChunkEncoder.get(queries.tokenizer_file(name))
        assert encoder.encode(text) == encoder.encode_whole([text])[0]


def test_cache_is_bounded(byte_file, monkeypatch):
    monkeypatch.setattr("asklens.llm.tokens.CACHE_PIECES", 20)
    encoder = ChunkEncoder(byte_file)
    text = " ".join(f"word{'abcdefghij'[i % 10]}{'klmnopq'[i % 7]}" for i in range(500))
    for part in (text[:1000], text[1000:], text):
        assert encoder.encode(part) == encoder.encode_whole([part])[0]
    assert len(encoder.cache.young) <= 20 and len(encoder.cache.old) <= 20


@pytest.mark.parametrize("file", ["word_file", "byte_file"])
@pytest.mark.parametrize("limit", [(1, 1), (300, 50), (1 << 24, 1 << 20)])
def test_columns_in_slices_of_any_size(file, limit, request, docs, monkeypatch):
    monkeypatch.setattr("asklens.llm.tokens.SLICE_BYTES", limit[0])
    monkeypatch.setattr("asklens.llm.tokens.GATHER_IDS", limit[1])
    encoder = ChunkEncoder(request.getfixturevalue(file))
    texts = [None, *ODD, *[r["text"][:2000] for r in docs.limit(20).collect()], "", None]
    column = pa.array(["left out", *texts, "left out"])[1:-1]  # a slice of a longer column
    assert list(encoder.encode_column(column)) == encoder.encode_whole([t or "" for t in texts])
    assert list(encoder.encode_column(pa.array([], pa.string()))) == []


def changed(path, to, **settings):
    kept = json.load(open(path))
    for key, value in settings.items():
        kept[key] = value(kept[key]) if callable(value) else value
    to.write_text(json.dumps(kept))
    return str(to)


def test_other_tokenizers_get_whole_texts(byte_file, word_file, tmp_path, docs):
    """A setting that a cut at spaces could break: nothing is cut, and the ids are the library's."""
    space = {"type": "Metaspace", "replacement": "Ġ", "prepend_scheme": "always", "split": False}
    token = {"id": 50257, "content": "of the", "single_word": False, "lstrip": False, "rstrip": False, "normalized": True, "special": False}
    others = [changed(byte_file, tmp_path / "a.json", pre_tokenizer=space),
              changed(byte_file, tmp_path / "b.json", normalizer={"type": "Replace", "pattern": {"String": "e t"}, "content": "et"}),
              changed(byte_file, tmp_path / "c.json", added_tokens=lambda kept: [*kept, token]),
              changed(word_file, tmp_path / "d.json", normalizer={"type": "Strip", "strip_left": True, "strip_right": True}),
              changed(byte_file, tmp_path / "e.json", pre_tokenizer={"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True})]
    texts = [*ODD, "one of the many, e to e t and of theirs", *[r["text"][:3000] for r in docs.limit(10).collect()]]
    for path in others:
        encoder = ChunkEncoder(path)
        assert encoder.kind == ""
        assert list(encoder.encode_column(pa.array(texts))) == [
            np.asarray(encoder.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    assert (ChunkEncoder(byte_file).kind, ChunkEncoder(word_file).kind) == ("bytes", "words")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3000), min_size=1, max_size=400))
def test_elias_fano(steps):
    values = np.cumsum(steps)
    ef = token_output.EliasFano.encode(values, int(values[-1]) + 1)
    again = token_output.EliasFano(len(values), ef.low_bits, ef.low.tobytes(), ef.high.tobytes(), ef.samples.tobytes())
    assert [again[i] for i in range(len(values))] == values.tolist() == again.all().tolist()
    size = 8 * (len(ef.low) + len(ef.high))
    assert size <= len(values) * (2 + max(1, int(values[-1] // len(values)).bit_length())) + 24


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-2**63, 2**63 - 1), min_size=1, max_size=300), st.data())
def test_elias_fano_some_of_any_ids(ids, data):
    ids = np.array(sorted(ids), dtype="<i8")
    ahead = ids.view("<u8") - ids[:1].view("<u8")
    ef = token_output.EliasFano.encode(ahead, int(ahead[-1]) + 1)
    first = data.draw(st.integers(0, len(ids)))
    stop = data.draw(st.integers(first, len(ids)))
    assert (ef.some(first, stop) + ids[0]).tolist() == ids[first:stop].tolist()
    assert [ef[i] for i in range(first, stop)] == ahead[first:stop].tolist()


def test_full_read_selects(monkeypatch):
    """The read takes starts and ids through the samples, and the ids are no plain table."""
    def whole(self):
        raise AssertionError("the whole sequence was decoded")

    monkeypatch.setattr(token_output.EliasFano, "all", whole)
    rng = random.Random(5)
    ids = [*sorted(rng.randrange(-10**6, 10**6) for _ in range(2500)), None, None]
    texts = [np.full(rng.randrange(1, 9), i, dtype="<u4").tobytes() for i in range(len(ids))]
    segment = token_output._segment(0, 0, 0, ids, texts, 2)
    before = segment.append_column("before", pa.array([7], pa.int64()))
    out = [r for b in token_output._reader(iter([before])) for r in b.to_pylist()]
    assert [(r["doc_id"], r["ids"]) for r in out] == list(zip(ids, texts))
    sizes = np.array([len(x) // 4 for x in texts])
    assert [r["start"] for r in out] == (7 + np.cumsum(sizes) - sizes).tolist() and [r["n_tokens"] for r in out] == sizes.tolist()
    sizes = {name: len(value) for name, value in segment.to_pylist()[0].items() if isinstance(value, bytes) and name != "ids"}
    assert sum(sizes.values()) < 4 * len(ids), "boundaries and ids together take less than half of a plain table"


def ids_of(path, text, end):
    tk = ChunkEncoder.get(path).tokenizer
    return np.array([*tk.encode(text or "", add_special_tokens=False).ids, end], dtype="<u4").tobytes()


def test_token_files_round_trip(spark, docs, odd, none, word_file):
    for df, segment in ((docs, 1 << 18), (docs, 500), (odd, 100)):
        path = scratch_path(spark, "test-tokens")
        token_output.write_tokens(df, path, word_file, segment_tokens=segment)
        got = sorted(((r["start"], r["doc_id"], r["n_tokens"], bytes(r["ids"])) for r in token_output.read_tokens(spark, path).collect()))
        want = [(r["doc_id"], ids_of(word_file, r["text"], 2)) for r in df.collect()]
        assert sorted(((g[1], g[3]) for g in got), key=repr) == sorted(want, key=repr)
        at, last = 0, -1
        for start, doc, n, ids in got:
            assert start == at and 4 * n == len(ids) and (doc is None or doc >= last)
            at, last = at + n, float("inf") if doc is None else doc
    path = scratch_path(spark, "test-tokens")
    token_output.write_tokens(none, path, word_file)
    assert token_output.read_tokens(spark, path).count() == 0


def check_packing(df, byte_file, window=1024, key="doc_id"):
    pieces = packing.pack_documents(df, byte_file, window=window).collect()
    docs, seqs = {}, {}
    for p in pieces:
        docs.setdefault(p["doc_id"], []).append(p)
        seqs.setdefault(p["sequence_id"], []).append(p)
    for s in seqs.values():
        s.sort(key=lambda p: p["offset"])
        at = 0
        for p in s:
            assert p["offset"] == at and p["length"] == len(p["ids"]) // 4 > 0
            at += p["length"]
        assert at == window or (at < window and at & (at - 1) == 0)
    assert sorted(seqs) == list(range(len(seqs)))
    return docs, sum(p["length"] for p in pieces)


def test_every_id_in_one_piece(docs, byte_file):
    for window in (1024, 64):
        got, _ = check_packing(docs, byte_file, window)
        for r in docs.collect():
            parts = sorted(got[r["doc_id"]], key=lambda p: p["start"])
            whole = b"".join(bytes(p["ids"]) for p in parts)
            assert whole == ids_of(byte_file, r["text"], 0) and parts[0]["doc_tokens"] * 4 == len(whole)
            assert [p["start"] for p in parts] == np.cumsum([0, *[p["length"] for p in parts]])[:-1].tolist()


def test_odd_and_empty(odd, none, byte_file):
    _, tokens = check_packing(odd, byte_file)
    assert tokens * 4 == sum(len(ids_of(byte_file, r["text"], 0)) for r in odd.collect())
    assert packing.pack_documents(none, byte_file).count() == 0


def test_level_minimises_the_squares():
    """Every placement against trying all levels."""
    rng, window = random.Random(4), 24
    levels = packing.SumOfSquares(window)
    for n in range(600):
        size = rng.randrange(1, window)
        before = levels.count.copy()
        options = []
        for level in range(window - size + 1):
            if level == 0 or before[level]:
                c = before.copy()
                c[level] -= level > 0
                c[level + size] += level + size < window
                options.append(int((c.astype(int) ** 2).sum()))
        levels.place((n, 0, bytes(4 * size)))
        assert int((levels.count ** 2).sum()) == min(options)
        assert [len(x) for x in levels.open] == levels.count.tolist()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=60))
def test_pack_task_loses_nothing(sizes):
    texts = [bytes(np.arange(n, dtype="<u4")) for n in sizes]
    seen = {i: [] for i in range(len(sizes))}
    partly = 0
    for pieces in packing.pack_task(enumerate(texts), 32):
        total = sum(len(ids) // 4 for _, _, ids in pieces)
        assert total == 32 or total & (total - 1) == 0 and total < 32
        partly += total < 32
        for doc, start, ids in pieces:
            seen[doc].append((start, ids))
    assert partly <= 5
    assert all(b"".join(x for _, x in sorted(seen[i])) == t for i, t in enumerate(texts))


def test_windows_closed_early_lose_nothing(spark, docs, byte_file):
    """A bound of open tokens that is reached again and again: every id once, at most one partial window a closing."""
    sizes = [random.Random(8).randrange(1, 90) for _ in range(300)]
    texts = [bytes(np.arange(n, dtype="<u4")) for n in sizes]
    got, partly = {}, 0
    for pieces in packing.pack_task(enumerate(texts), 32, max_open_tokens=200):
        total = sum(len(ids) // 4 for _, _, ids in pieces)
        assert total == 32 or total & (total - 1) == 0
        partly += total < 32
        for doc, start, ids in pieces:
            got.setdefault(doc, []).append((start, ids))
    assert all(b"".join(x for _, x in sorted(got[i])) == t for i, t in enumerate(texts))
    assert 5 < partly <= 5 * (sum(sizes) // 200 + 1)
    rows = packing.pack_documents(docs, byte_file, max_open_tokens=2000).collect()
    whole = packing.pack_documents(docs, byte_file).collect()
    assert sum(r["length"] for r in rows) == sum(r["length"] for r in whole)
    assert len({r["sequence_id"] for r in rows}) == max(r["sequence_id"] for r in rows) + 1


def test_digests(spark):
    got = queries.op9_window_packing(spark, "/root/testdata/sf0.001").where("start = 0 AND length = doc_tokens").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(F.col("doc_id") == got["doc_id"]).first()["text"]
    assert zlib.crc32(ids_of(queries.tokenizer_file("byte_bpe_50k.json"), text, 0)) == got["ids_crc32"]
