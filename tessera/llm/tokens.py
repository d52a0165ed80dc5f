"""Token-ID output: texts to ids, ids to a Huffman-coded block file, and back.

File format (a folder; Parquet is the container, so any store that Spark reads will do):

* ``codebook``: one row per id in use: ``id, length`` (canonical code, at most ``limit`` bits);
* ``blocks/part=<n>``: one row per block of whole documents, in ascending document order inside a
  part and over parts: ``start`` (ids before the block), ``doc_ids``, ``doc_tokens`` (ids of each
  document), ``bits`` (packed codes), ``offsets`` (bit offset of every 128th id).  A block decodes
  on its own.

Steps: documents are range-partitioned by id, tokenised once, and the ids written as a work table;
counts of all ids give the code; ids are packed block by block.  Only the code (bounded by the
vocabulary) and one total per range partition reach the driver.

Defined results: a NULL or empty text has the end id only; NULL document ids come first; rows that
repeat a document id are kept, ordered by a hash of their text; an empty table gives an empty file.
Strings of special tokens inside a text are those tokens, unless ``plain_specials`` is set.  Extra
columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import huffman
from tessera.llm.vec import chunks, utf8
from tessera.llm.words import need
from tessera.session import scratch_dir

#: A space is where the byte-level pre-tokeniser may always be cut, unless white space follows it.
_ODD = ("[ ][\\t-\\r \\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}"
        "\\x{202f}\\x{205f}\\x{3000}]")
#: Pieces of text whose ids a Python worker remembers before it drops rare ones (memory only).
REMEMBER = 600_000
#: Ids in a block at least, unless its part ends.
BLOCK = 1 << 16
_TOKENIZERS: dict[tuple[str, bool], Pieces] = {}


class Pieces:
    """Encodes texts with a byte-level BPE tokeniser file, each distinct piece only once.

    Pieces are cut before a space that is followed by a non-space: byte-level pre-tokenisation
    always begins a new word there, so the ids of a text are those of its pieces in a row.  A text
    with other white space after a space is encoded whole.
    """

    def __init__(self, path: str, plain_specials: bool = False):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = plain_specials
        # The tokeniser's own cache of words is no use: a piece is encoded once and remembered here.
        model = self.tok.model
        self.uncached = hasattr(model, "_resize_cache")
        if self.uncached:
            model._resize_cache(0)
            self.tok.model = model
        vocab = self.tok.get_vocab()
        # A text that holds one of these is encoded whole: they are found before words are.
        self.specials = [] if plain_specials else [
            t.content for t in self.tok.get_added_tokens_decoder().values() if t.special]
        self.spaced = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.spaced[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True  # a space byte
        self.known = pa.array([], pa.large_string())
        self.flat, self.start, self.size, self.used = (
            np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64),
            np.zeros(0, np.int64))

    def _forget(self) -> None:
        """Keep only pieces that came up again."""
        keep = np.flatnonzero(self.used > 1)
        if len(keep) > REMEMBER // 2:
            keep = keep[np.argsort(-self.used[keep], kind="stable")[:REMEMBER // 2]]
        self.known = self.known.take(pa.array(keep))
        size = self.size[keep]
        begin = np.cumsum(size) - size
        self.flat = self.flat[np.repeat(self.start[keep] - begin, size) + np.arange(size.sum())]
        self.start, self.size, self.used = begin, size, self.used[keep]

    def _cut(self, n: int) -> None:
        end = int(self.start[n]) if n < len(self.start) else len(self.flat)
        self.flat = self.flat[:end]
        self.start, self.size, self.used = self.start[:n], self.size[:n], self.used[:n]

    def _in_a_row(self, pieces: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids and sizes of pieces that begin with a space: many are encoded as one text, which is
        cut at the ids that begin with a space."""
        flat, size = [], []
        groups = [pieces[i:i + 256] for i in range(0, len(pieces), 256)]
        for group, e in zip(groups, self.tok.encode_batch_fast(
                ["".join(g) for g in groups], add_special_tokens=False)):
            ids = np.asarray(e.ids, dtype=np.uint32)
            cut = np.flatnonzero(self.spaced[ids])
            if len(cut) == len(group) and cut[0] == 0:
                flat.append(ids)
                size.append(np.diff(np.append(cut, len(ids))))
            else:
                f, n = self._each(group)
                flat += f
                size += n
        return flat, size

    def _each(self, pieces: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        got = [np.asarray(e.ids, dtype=np.uint32)
               for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]
        return got, [np.array([len(g) for g in got], dtype=np.int64)]

    def _learn(self, pieces: list[str], spaced: bool) -> np.ndarray:
        """Encode new pieces; their places in the store."""
        flat, size = (self._in_a_row if spaced else self._each)(pieces)
        size, n = np.concatenate(size), len(self.size)
        self.start = np.concatenate([self.start, np.cumsum(size) - size + len(self.flat)])
        self.size, self.flat = np.concatenate([self.size, size]), np.concatenate([self.flat, *flat])
        self.used = np.concatenate([self.used, np.zeros(len(size), np.int64)])
        return np.arange(n, n + len(size))

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where each piece that begins with a space is in the store."""
        at = pc.index_in(pieces, value_set=self.known)
        out = at.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        if at.null_count:
            fresh = pieces.filter(at.is_null())
            out[out < 0] = self._learn(fresh.to_pylist(), True)
            self.known = pa.concat_arrays([self.known, fresh])
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts joined, and where each begins (one entry more than texts)."""
        if len(self.known) > REMEMBER:
            self._forget()
        texts = texts.cast(pa.large_string()).fill_null("")
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        for special in self.specials:
            odd = odd | pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), texts)
        split = pc.split_pattern(plain, " ")
        offs = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        values = coded.dictionary
        head = np.zeros(len(code), dtype=bool)
        head[offs[:-1]] = True
        inner, firsts = (np.flatnonzero(np.bincount(x, minlength=len(values)))
                         for x in (code[~head], code[head]))
        none, space = (pa.scalar(x, pa.large_string()) for x in ("", " "))
        spaced = pc.binary_join_element_wise(none, values.take(pa.array(inner)), space)
        of_inner = np.zeros(len(values), dtype=np.int64)
        of_head = np.zeros(len(values), dtype=np.int64)
        of_inner[inner] = self._places(spaced)
        of_head[firsts] = self._learn(values.take(pa.array(firsts)).to_pylist(), False)
        self.used[of_inner[inner]] += 1
        piece = np.where(head, of_head[code], of_inner[code])
        size = self.size[piece]
        ends = np.cumsum(size)
        take = np.repeat(self.start[piece] - (ends - size), size) + np.arange(
            int(ends[-1]) if len(ends) else 0)
        ids = self.flat[take]
        self._cut(len(self.known))  # first pieces of texts are not kept
        bounds = np.concatenate([[0], ends])[offs]
        if odd.any():
            parts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            for i in np.flatnonzero(odd):
                parts[i] = np.asarray(self.tok.encode(texts[int(i)].as_py(),
                                                      add_special_tokens=False).ids, np.uint32)
            ids = np.concatenate(parts).astype(np.uint32)
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, bounds


def encode_texts(path: str, texts: pa.Array, plain_specials: bool = False
                 ) -> tuple[np.ndarray, np.ndarray]:
    """:meth:`Pieces.encode` with the tokeniser that this worker process keeps for ``path``."""
    key = (path, plain_specials)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = Pieces(path, plain_specials)
    return _TOKENIZERS[key].encode(texts)


def _tokenise(path: str, end_id: int, kind: str, plain_specials: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = 0
        for batch in batches:
            _, off = utf8(batch.column("text"))
            for i, j in chunks(off, 6 << 20):
                part = batch.slice(i, j - i)
                ids, bounds = encode_texts(path, part.column("text"), plain_specials)
                if max(end_id, int(ids.max(initial=0))) > np.iinfo(kind).max:
                    raise ValueError("ids exceed the vocabulary bound")
                n = j - i
                ends = bounds[1:] + np.arange(n)  # places of the end ids
                flat = np.full(len(ids) + n, end_id, dtype=kind)
                inner = np.ones(len(flat), dtype=bool)
                inner[ends] = False
                flat[inner] = ids
                cut = np.concatenate([[0], ends + 1])
                size = np.diff(cut)
                value = pa.Array.from_buffers(pa.large_binary(), n, [
                    None, pa.py_buffer(cut.astype(np.int64) * flat.itemsize), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("part"), part.column("doc_id").cast(pa.int64()),
                     pa.array(start + cut[:-1]), pa.array(size), value.cast(pa.binary())],
                    names=["part", "doc_id", "begin", "n", "ids"])
                start += len(flat)
    return run


def _count(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            got = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), kind))
            if len(got) > len(total):
                total = np.concatenate([total, np.zeros(len(got) - len(total), np.int64)])
            total[:len(got)] += got
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, type=pa.int64()),
                                          pa.array(total[used], type=pa.int64())],
                                         names=["id", "n"])
    return run


def _pack(lengths: np.ndarray, offsets: dict[int, int], kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = huffman.canonical(lengths)
        held: list[tuple[int | None, np.ndarray]] = []
        at = (-1, 0, 0)  # part, begin of the block, begin of the next document

        def block() -> pa.RecordBatch:
            ids = np.concatenate([x for _, x in held])
            bits, marks = huffman.pack(ids, codes, lengths)
            row = [at[0], offsets[at[0]] + at[1], [d for d, _ in held], [len(x) for _, x in held],
                   bits, marks]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], type=t) for v, t in zip(row, _BLOCK_TYPES)], names=_BLOCK_NAMES)

        for batch in batches:
            parts, begins = batch.column("part").to_pylist(), batch.column("begin").to_pylist()
            docs = batch.column("doc_id").to_pylist()
            for part, begin, doc, value in zip(parts, begins, docs, batch.column("ids")):
                ids = np.frombuffer(value.as_py(), kind)
                if held and ((part, begin) != (at[0], at[2]) or at[2] - at[1] >= BLOCK):
                    yield block()
                    held = []
                if not held:
                    at = (part, begin, begin)
                held.append((doc, ids))
                at = (part, at[1], begin + len(ids))
        if held:
            yield block()
    return run


_BLOCK_NAMES = ["part", "start", "doc_ids", "doc_tokens", "bits", "offsets"]
_BLOCK_TYPES = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(),
                pa.binary()]


def write_tokens(docs: DataFrame, out: str, tokenizer: str, end_id: int = 2, limit: int = 20,
                 vocab: int = 1 << 16, plain_specials: bool = False) -> None:
    """Tokenise ``docs`` (``doc_id, text``) and write the block file to the folder ``out``.

    ``vocab`` bounds the ids (it decides how ids are held on the way).  Strings of special tokens inside a
    text become those tokens, as the tokeniser does by itself; with ``plain_specials`` they are ordinary
    text.
    """
    need(docs, "doc_id", "text")
    spark = docs.sparkSession
    kind = "<u2" if vocab <= 1 << 16 else "<u4"
    work = scratch_dir(spark, "token-ids")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
     .repartitionByRange(n, "doc_id", F.xxhash64("text"))
     .sortWithinPartitions("doc_id", F.xxhash64("text"))
     .select(F.spark_partition_id().alias("part"), "doc_id", "text")
     .mapInArrow(_tokenise(tokenizer, end_id, kind, plain_specials),
                 "part int, doc_id long, begin long, n long, ids binary")
     .write.option("compression", "zstd").parquet(work))
    ids = spark.read.parquet(work)
    counts = (ids.select("ids").mapInArrow(_count(kind), "id long, n long")
              .groupBy("id").agg(F.sum("n").alias("n")).collect())  # at most one row per id
    weight = np.zeros(max([r.id for r in counts], default=-1) + 1, dtype=np.int64)
    for r in counts:
        weight[r.id] = r.n
    lengths = huffman.code_lengths(weight, limit)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)],
                          "id long, length int").coalesce(1).write.parquet(f"{out}/codebook")
    before, offsets = 0, {}
    for r in ids.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        offsets[r.part], before = before, before + r.n  # one row per range partition
    (ids.select("part", "doc_id", "begin", "ids")
     .mapInArrow(_pack(lengths, offsets, kind),
                 "part int, start long, doc_ids array<long>, doc_tokens array<long>, bits binary, "
                 "offsets binary")
     .write.option("compression", "none").partitionBy("part").parquet(f"{out}/blocks"))


def read_blocks(spark: SparkSession, out: str) -> tuple[DataFrame, np.ndarray]:
    """The blocks of a file and its code lengths by id."""
    book = spark.read.parquet(f"{out}/codebook").collect()  # bounded by the vocabulary
    lengths = np.zeros(max([r.id for r in book], default=-1) + 1, dtype=np.uint8)
    for r in book:
        lengths[r.id] = r.length
    schema = ("start long, doc_ids array<long>, doc_tokens array<long>, bits binary, "
              "offsets binary, part int")
    return spark.read.schema(schema).parquet(f"{out}/blocks"), lengths


def _decoded(lengths: np.ndarray, emit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = huffman.decode_table(lengths)
        for batch in batches:
            for i in range(0, batch.num_rows, 16):  # blocks decoded side by side
                part = batch.slice(i, 16)
                sizes = [np.asarray(x, dtype=np.int64) for x in
                         part.column("doc_tokens").to_pylist()]
                ids = huffman.unpack(
                    [(b.as_py(), o.as_py(), int(s.sum())) for b, o, s in
                     zip(part.column("bits"), part.column("offsets"), sizes)], table)
                size = np.concatenate(sizes)
                ends = np.cumsum(size)
                start = np.concatenate([s + np.cumsum(n) - n for s, n in
                                        zip(part.column("start").to_pylist(), sizes)])
                doc = [d for row in part.column("doc_ids").to_pylist() for d in row]
                yield emit(doc, start, size, [ids[b - n:b] for b, n in zip(ends, size)])
    return run


def _digest(doc, start, size, ids) -> pa.RecordBatch:
    crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, type=pa.int64()), pa.array(start), pa.array(size),
         pa.array(crc, type=pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def _whole(doc, start, size, ids) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, type=pa.int64()), pa.array(start), pa.array(size),
         pa.array([x.astype(np.int64) for x in ids], type=pa.list_(pa.int64()))],
        names=["doc_id", "start", "n_tokens", "ids"])


def read_tokens(spark: SparkSession, out: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` decoded from a file."""
    blocks, lengths = read_blocks(spark, out)
    return blocks.select("start", "doc_ids", "doc_tokens", "bits", "offsets").mapInArrow(
        _decoded(lengths, _whole), "doc_id long, start long, n_tokens long, ids array<long>")


def read_digests(spark: SparkSession, out: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` decoded from a file (crc32 of little-endian uint32)."""
    blocks, lengths = read_blocks(spark, out)
    return blocks.select("start", "doc_ids", "doc_tokens", "bits", "offsets").mapInArrow(
        _decoded(lengths, _digest), "doc_id long, start long, n_tokens long, ids_crc32 long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
