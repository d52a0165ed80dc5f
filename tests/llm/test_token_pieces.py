"""Pieces are encoded without the tokeniser's cache, and give the ids of whole texts."""

import numpy as np
import pyarrow as pa

from tessera.llm import tokens


def test_no_cache_of_the_tokeniser_and_the_same_ids():
    from tokenizers import Tokenizer

    path = tokens.default_tokenizer()
    plain = Tokenizer.from_file(path)
    words = [f"wörd{n * 7919 % 3001}x, it's {n}" for n in range(4000)]
    texts = [" ".join(words), "", " lead", "two  spaces", "a\tb <|endoftext|> c", " ".join(words[::-1]), None, "one"]
    pieces = tokens.Pieces(path)
    assert pieces.uncached == hasattr(plain.model, "_resize_cache")
    for _ in range(2):
        ids, bounds = pieces.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [
            plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ids.dtype == np.uint32
