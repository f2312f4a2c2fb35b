import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from moodtick.llm import bpe, chunks, wavelet
from moodtick.llm.common import read

SF = "/root/testdata/sf0.001"
RANKS = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
ENCODING = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
OWN = bpe.BPE(RANKS, P.PATTERN)
FILES = wavelet.Tokens(P.path("byte_bpe_50k.json"))
LIBRARY = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
INERT = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
INERT.encode_special_tokens = True
INERT_FILES = wavelet.Tokens(P.path("byte_bpe_50k.json"), inert=True)
ALPHABETS = ["abc é\n", "a", "ab ", "the  \t\n.,'s'll 12²Ⅷ", "\x1c\x1d\x85\xa0 a 　!", "xyzüß漢字 😀", " \n", "<|endoftext|> "]
TEXTS = st.sampled_from(ALPHABETS).flatmap(lambda a: st.text(st.sampled_from(a), max_size=300)) | st.text(max_size=80)


def ids(x):
    return np.frombuffer(OWN.encode(x), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.sampled_from([(1 << 10, 4, 64), (1 << 15, 48, 64), (40, 4, 8), (16, 2, 1), (100, 1, 64)]))
def test_tree_reduction_gives_the_library_ids(text, sizes):
    bpe.LEAF_TEXT, bpe.LEAF, bpe.WINDOW = sizes
    OWN.pieces.clear()
    OWN.by_chunk.clear()
    OWN.nodes.clear()
    try:
        assert ids(text) == ENCODING.encode_ordinary(text)
        assert OWN.decode(OWN.encode(text)) == text.encode()
    finally:
        bpe.LEAF_TEXT, bpe.LEAF, bpe.WINDOW = 1 << 10, 4, 64


@pytest.mark.parametrize("text", ["a" * 6000, "ab" * 20_000, " " * 30_000, "né" * 9_000, "word " * 30_000 + "x" * 4_000, base64.b64encode(bytes(range(256)) * 100).decode()])
def test_long_texts(text):
    assert ids(text) == ENCODING.encode_ordinary(text)


def test_the_tree_is_the_path_of_every_text(spark):
    """Joins over the documents: more than one a text of more than one leaf, and one for
    each new word of more than one leaf."""
    own = bpe.BPE(RANKS, P.PATTERN)
    texts = [r.text for r in read(spark, SF, "documents").select("text").collect()]
    for t in texts:
        own.encode(t)
    long = [t for t in texts if len(t) > 2 * bpe.LEAF_TEXT]
    assert len(long) > 50 and own.joins["text"] > 2 * len(long)
    assert own.joins["piece"] > 0.9 * sum(len(c.encode()) > bpe.LEAF for c in own.by_chunk if c.isalpha())


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_chunks_and_token_files_encoder(text):
    first, *rest = chunks.chunks(text)
    assert first + "".join(map(chunks.whole, rest)) == text
    assert np.frombuffer(FILES.encode(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(INERT_FILES.encode(text), "<u4").tolist() == INERT.encode(text, add_special_tokens=False).ids


def test_special_tokens_in_a_text():
    text = "a <|endoftext|> b"
    assert np.frombuffer(FILES.encode(text), "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids == [64, 220, 50256, 275]
    assert 50256 not in np.frombuffer(INERT_FILES.encode(text), "<u4")


MIXED = [
    None, "", " ", "\n", "a", " a", "a ", "and, and. (and) don't, it's. l'été, naïve... ça!\nwas\n", "a  b\tc", "漢字, 漢字 кот, кот",
    "x <|endoftext|> x", "12, 12 a1, 1a. à b à, à", "\x1c a\x85b\xa0 c", "the " * 500,
]


def library(texts, end):
    return [[*LIBRARY.encode(t or "", add_special_tokens=False).ids, end] for t in texts]


@pytest.mark.parametrize("run", [1, 3, wavelet.RUN])
def test_texts_together(run):
    own = wavelet.Tokens(P.path("byte_bpe_50k.json"))
    assert own.run == wavelet.RUN
    own.run = run
    for texts in (MIXED, MIXED[::-1], [], [None], ["漢字 漢字, 漢字"], MIXED[:3]):
        for limit in (wavelet.CHUNKS, -1):  # what is remembered changes nothing
            own.left = limit
            ids, sizes = own.many(texts, np.array([7], "<u4").tobytes())
            want = library(texts, 7)
            assert ids.tolist() == [i for w in want for i in w] and sizes.tolist() == list(map(len, want))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | TEXTS, max_size=8))
def test_any_texts_together(texts):
    ids, sizes = FILES.many(texts)
    want = [w[:-1] for w in library(texts, 0)]
    assert ids.tolist() == [i for w in want for i in w] and sizes.tolist() == list(map(len, want))


def test_few_calls_of_the_model():
    """The model is asked once for many new words, and for a word once, whatever marks stand behind it."""
    own, asked = wavelet.Tokens(P.path("byte_bpe_50k.json")), []
    model = own.model
    own.model = type("Model", (), {"tokenize": lambda _, x: asked.append(x) or model.tokenize(x)})()
    words = [a + b + c for a in ("th", "st", "é") for b in "aeiouyäö" for c in ("nd", "r", "wh", "ss")]
    texts = ["I " + " ".join(w + m for w in words) for m in ("", ",", ".", "!?")]
    ids, _ = own.many(texts)
    assert ids.tolist() == [i for w in library(texts, 0) for i in w[:-1]]
    assert len(asked) <= -(-len(words) // wavelet.RUN) + 3
    own.many(texts)
    assert len(asked) <= -(-len(words) // wavelet.RUN) + 3


def test_tokens_over_a_blank():
    """Words go to the model one by one if a token reaches from a letter over a blank."""
    shown = [t.translate(wavelet._LATIN) for t in ("a b", "é b", " a b", " a", "a", "  ", ", a")]
    assert [wavelet._crosses(t) for t in shown] == [True, True, True, False, False, False, False]
    nbsp, cut = "Âł" + wavelet._BLANK, "ł" + wavelet._BLANK  # a whole character that is no letter, a part of one
    assert not wavelet._crosses(nbsp) and wavelet._crosses(cut)


def test_memory_is_bounded():
    memo = chunks.Memo(lambda k: k, 10_000)
    for i in range(500):
        assert memo[str(i)] == str(i)
    assert len(memo) < 50


def test_bpe_rows(spark, edge, no_rows):
    own = edge.withColumnRenamed("fp", "decoded")
    out = bpe.encoded(own, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    assert out.columns == [*own.columns, "_ids", "_decoded"]
    for r in out.collect():
        want = ENCODING.encode_ordinary(r.text or "")
        assert np.frombuffer(bytes(r._ids), "<u4").tolist() == want and bytes(r._decoded) == (r.text or "").encode()
    assert bpe.encoded(no_rows, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def plain_files(rows, end):
    out, start = [], 0
    for d, t in rows:
        own = np.array([*LIBRARY.encode(t or "", add_special_tokens=False).ids, end], "<u4")
        out.append((d, start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    return out


@pytest.mark.parametrize("shard", [1 << 21, 700])
def test_token_files(spark, monkeypatch, shard):
    monkeypatch.setattr(wavelet, "SHARD", shard)
    docs = read(spark, SF, "documents")
    files = wavelet.write_shards(docs, P.path("byte_bpe_50k.json"))
    files = spark.createDataFrame(files.collect(), files.schema)
    got = wavelet.read_shards(wavelet.with_starts(files)).orderBy("start").collect()
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").orderBy("doc_id").collect()]
    assert [tuple(r) for r in got] == plain_files(rows, 0)
    # token access, counting and lookup from one file
    r = files.orderBy("part", "shard").first()
    _, sizes, matrix = wavelet.open_shard(r.path)
    flat = np.concatenate([[*LIBRARY.encode(t, add_special_tokens=False).ids, 0] for _, t in rows])[: matrix.n]
    at = np.arange(0, matrix.n, 7)
    assert (matrix.access(at) == flat[at]).all() and sizes.sum() == matrix.n
    common = int(np.bincount(flat).argmax())
    assert (matrix.occurrences(common) == np.flatnonzero(flat == common)).all()
    assert (matrix.occurrences(common, 3, 9) == np.flatnonzero(flat == common)[3:9]).all()
    assert matrix.count(common, 50, 400) == (flat[50:400] == common).sum() and matrix.count(60_000) == 0
    with pytest.raises(IndexError):
        matrix.access([matrix.n])


def test_token_files_of_edge_cases(spark, edge, no_rows):
    files = wavelet.write_shards(edge, P.path("byte_bpe_50k.json"), end=7)
    files = spark.createDataFrame(files.collect(), files.schema)
    got = wavelet.read_shards(wavelet.with_starts(files)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 1, 1, 2, 3, 4, 5, 6]
    assert sorted(r.ids_crc32 for r in got) == sorted(x[3] for x in plain_files([(r.doc_id, r.text) for r in edge.collect()], 7))
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got]).tolist()[:-1]]
    assert wavelet.write_shards(no_rows, P.path("byte_bpe_50k.json")).count() == 0


def test_one_value_matrix():
    for tokens in ([], [0], [0] * 130, [5] * 64):
        m = wavelet.Matrix.of(np.array(tokens, np.uint32))
        assert m.tokens().tolist() == tokens and m.access(np.arange(len(tokens))).tolist() == tokens


def test_digest_of_query_columns(spark):
    from moodtick.llm import queries

    for r in queries.op10_bpe(spark, SF).join(read(spark, SF, "documents"), "doc_id").collect():
        want = np.array(ENCODING.encode_ordinary(r.text), "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(want) // 4, hashlib.sha256(want).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest())


@pytest.mark.parametrize("size", [1, 300, 1 << 20])
def test_slices_of_a_batch(size, monkeypatch):
    monkeypatch.setattr(wavelet, "SLICE", size)
    batch = pa.RecordBatch.from_pydict({"doc_id": range(40), "text": [None if i % 7 == 3 else "é" * (i * i % 90) for i in range(40)]})
    got = list(wavelet._slices(batch))
    assert pa.Table.from_batches(got).equals(pa.Table.from_batches([batch]))
    assert all(s.num_rows == 1 or sum(len((t or "").encode()) for t in s.column(1).to_pylist()) <= size for s in got)
    assert list(wavelet._slices(batch.slice(0, 0))) == []
