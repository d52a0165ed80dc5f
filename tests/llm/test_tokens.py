"""Token output against direct encoding and exact round trips."""

import tempfile
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import huffman, tokens
from tessera.llm.queries import QUERIES

from ..conftest import SF_SMALL

TEXTS = ["", " ", "  a", "a  b", "a \n b", "a\n b c ", "é <|endoftext|> x", "tab\t x", "a \x1c b",
         "　a 　b", None, "a  <|endoftext|>  b<|endoftext|>", "hello <|endoftext|> world", "a" * 5000, "don't I'll 12 345", "words " * 3000]


def direct(text, plain_specials=False):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.default_tokenizer())
    if plain_specials:
        tok.encode_special_tokens = True
    return tok.encode(text or "", add_special_tokens=False).ids + [2]


def expected(rows):
    out, start = [], 0
    for doc_id, text in rows:
        ids = direct(text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_pieces_give_the_ids_of_whole_texts():
    import pyarrow as pa

    ids, at = tokens.encode_texts(tokens.default_tokenizer(), pa.array(TEXTS))
    assert [list(ids[a:b]) + [2] for a, b in zip(at[:-1], at[1:])] == [direct(t) for t in TEXTS]


def test_special_tokens_in_texts():
    import pyarrow as pa

    text = "hello <|endoftext|> world"
    assert direct(text) == [31373, 220, 50256, 995, 2]  # a tokeniser left at its defaults
    ids, _ = tokens.encode_texts(tokens.default_tokenizer(), pa.array([text, "x"]))
    assert list(ids[:4]) == [31373, 220, 50256, 995]
    ids, at = tokens.encode_texts(tokens.default_tokenizer(), pa.array(TEXTS), plain_specials=True)
    assert [list(ids[a:b]) + [2] for a, b in zip(at[:-1], at[1:])] == [direct(t, True) for t in TEXTS]


def test_whole_table_reads_back(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet")
            .select("doc_id", "text").orderBy("doc_id").collect()]
    got = QUERIES["op2_token_ids"](spark, SF_SMALL).orderBy("doc_id").collect()
    assert [tuple(r)[:4] for r in got] == expected(rows)


def test_edge_rows(spark):
    rows = list(enumerate(TEXTS)) + [(None, "no id"), (3, "a  b"), (3, "a  b")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, start int")
    out = tempfile.mkdtemp(prefix="tokens-") + "/f"
    tokens.write_tokens(docs, out, tokens.default_tokenizer())
    got = tokens.read_tokens(spark, out).orderBy("start").collect()
    order = sorted(rows, key=lambda r: -1 if r[0] is None else r[0])
    assert [r.doc_id for r in got] == [r[0] for r in order]
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got])[:-1])
    assert {(r.doc_id, tuple(r.ids)) for r in got} == {(d, tuple(direct(t))) for d, t in rows}
    assert len(got) == len(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    out = tempfile.mkdtemp(prefix="tokens-") + "/f"
    tokens.write_tokens(docs, out, tokens.default_tokenizer())
    assert tokens.read_tokens(spark, out).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=0, max_size=900), st.integers(6, 20))
def test_codes_round_trip(ids, limit):
    ids = np.array(ids, dtype=np.uint32)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=41), limit)
    used = lengths[lengths > 0].astype(int)
    assert used.max(initial=0) <= limit and (2.0 ** -used).sum() <= 1
    half = len(ids) // 2
    blocks = [(*huffman.pack(x, huffman.canonical(lengths), lengths), len(x))
              for x in (ids[:half], ids[half:])]
    assert huffman.unpack(blocks, huffman.decode_table(lengths)).tolist() == ids.tolist()


def test_lengths_are_optimal_without_a_binding_limit():
    import heapq

    counts = np.array([5, 9, 12, 13, 16, 45, 1, 1, 2, 0])
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a + b
        heapq.heappush(heap, a + b)
    assert (huffman.code_lengths(counts, 15) * counts).sum() == cost
    with pytest.raises(ValueError):
        huffman.code_lengths(counts, 3)
