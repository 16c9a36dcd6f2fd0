"""BPE encoding and decoding through a distinct-word table.

Encoding.  Tasks split their documents into words, chunk by chunk.  Each distinct
word of a chunk is sent once to the hash range it belongs to; there all chunks'
words meet, every distinct word is encoded once, and the ids return to the chunks
that hold the word.  In the chunk they are joined back by position.  A chunk
travels to its ids as numbers into its own word list, which is smaller than its
text.  However frequent a word is, a chunk sends it once, so no range is hot; the
number of ranges follows the size of the input, so a range's share does not grow.

A chunk is known by a hash of its content.  The input is read twice and must be
read in the same partitions both times (a table, as in the registered query);
where it is not, ids are missing for a chunk and the job fails rather than give
wrong ids.

Decoding is a map-side join of ids with the id-to-piece table, which is as large
as the vocabulary; pieces are joined by one space, which is what the library does
for a tokenizer without a decoder.

Defined results: NULL or empty text has no ids and decodes to the empty text;
very long texts are one row each; repeated rows give repeated results; a NULL id
of a document is kept; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import wordcodec
from .common import map_documents, slices, text_of

CHUNK_CHARS = 4_000_000
#: Characters of input for a range of words.
RANGE_CHARS = 1 << 26
TEXTS = ["n_tokens", "ids_text", "decoded"]


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


class Chunk:
    """Documents as numbers into the list of their distinct words, which is ordered
    by range, then first occurrence."""

    def __init__(self, rows: list[tuple[str | None, str]], ranges: int):
        from xxhash import xxh3_128, xxh32_intdigest
        content, number = xxh3_128(), defaultdict()
        number.default_factory = number.__len__
        self.ids, coded = [], []
        for doc_id, text in rows:
            data = text.encode("utf-8", "replace")
            content.update(f"{doc_id} {len(data)} ".encode() + data)
            words = data.split()
            self.ids.append(doc_id)
            coded.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
        self.key = content.hexdigest()
        words = list(number)
        own = np.fromiter((xxh32_intdigest(w) % ranges for w in words), np.int64, len(words))
        order = np.argsort(own, kind="stable")
        place = np.empty(len(words), np.uint32)
        place[order] = np.arange(len(words), dtype=np.uint32)
        self.words = [words[i] for i in order.tolist()]
        self.ranges = own[order]
        self.sizes = np.fromiter(map(len, coded), np.uint32, len(coded))
        self.numbers = place[np.concatenate(coded)] if len(words) else np.zeros(0, np.uint32)


def chunks(batches: Iterator[pd.DataFrame], ranges: int, size: int) -> Iterator[Chunk]:
    rows, held = [], 0
    for b in batches:
        for row in zip(b["doc_id"], b["text"], strict=True):
            rows.append(row)
            held += len(row[1])
            if held >= size:
                yield Chunk(rows, ranges)
                rows, held = [], 0
    if rows:
        yield Chunk(rows, ranges)


def word_lists(docs: DataFrame, ranges: int, size: int) -> DataFrame:
    """range, chunk, words: each distinct word of a chunk once."""
    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for c in chunks(batches, ranges, size):
            first = np.flatnonzero(np.diff(c.ranges, prepend=-1)).tolist()
            rows = [(int(c.ranges[a]), c.key, _pack(b" ".join(c.words[a:b])))
                    for a, b in zip(first, [*first, len(c.words)][1:], strict=False)]
            yield pd.DataFrame(rows, columns=["range", "chunk", "words"])
    return docs.mapInPandas(split, "range int, chunk string, words binary")


def encode_words(lists: DataFrame, path: str) -> DataFrame:
    """chunk, range, ids, sizes: the ids of each list's words; a distinct word is encoded once."""
    def encode(key, rows: pd.DataFrame) -> pd.DataFrame:
        c = wordcodec.codec(path)
        split = [_unpack(w).split() for w in rows["words"]]
        distinct = list(set().union(*split))
        known: dict[bytes, bytes] = {}
        for i in range(0, len(distinct), 50_000):
            part = distinct[i:i + 50_000]
            known.update(zip(part, c.encode_words(part), strict=True))
        out = []
        for chunk, words in zip(rows["chunk"], split, strict=True):
            parts = list(map(known.__getitem__, words))
            out.append((chunk, key[0], _pack(b"".join(parts)), _pack(np.fromiter(map(len, parts), np.uint32, len(parts)).tobytes())))
        return pd.DataFrame(out, columns=["chunk", "range", "ids", "sizes"])
    return lists.groupBy("range").applyInPandas(encode, "chunk string, range int, ids binary, sizes binary")


def numbered(docs: DataFrame, ranges: int, size: int) -> DataFrame:
    """chunk, n_words and its documents: ids, sizes in words, numbers of their words."""
    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for c in chunks(batches, ranges, size):
            planes = c.numbers.view(np.uint8).reshape(-1, 4).T.tobytes()    # high bytes together: mostly zero
            yield pd.DataFrame([(c.key, len(c.words), c.ids, _pack(c.sizes.tobytes()), _pack(planes))],
                               columns=["chunk", "n_words", "doc_ids", "sizes", "numbers"])
    return docs.mapInPandas(number, "chunk string, n_words long, doc_ids array<string>, sizes binary, numbers binary")


def _assemble(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Ids back to their positions in the documents of one chunk."""
    right = right.drop_duplicates("range").sort_values("range")
    flat = b"".join(map(_unpack, right["ids"]))
    ends = np.cumsum(np.frombuffer(b"".join(map(_unpack, right["sizes"])), np.uint32), dtype=np.int64).tolist()
    table = [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]
    out = []
    for n, doc_ids, sizes, numbers in zip(left["n_words"], left["doc_ids"], left["sizes"], left["numbers"], strict=True):
        if n != len(table):
            raise ValueError("the documents were read in other partitions the second time")
        numbers = np.ascontiguousarray(np.frombuffer(_unpack(numbers), np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
        at = 0
        for doc_id, size in zip(doc_ids, np.frombuffer(_unpack(sizes), np.uint32).tolist(), strict=True):
            out.append((doc_id, b"".join(map(table.__getitem__, numbers[at:at + size].tolist()))))
            at += size
    return pd.DataFrame(out, columns=["doc_id", "ids"])


def _texts(packed: pd.Series, path: str) -> pd.DataFrame:
    """n_tokens, ids_text and decoded of packed ids: each id is looked up in the
    id-to-piece table, which the worker holds."""
    c = wordcodec.codec(path)
    pieces, numbers = c.pieces(), c.numbers()
    out = []
    for x in packed:
        ids = np.frombuffer(x, dtype=c.dtype).tolist()
        out.append((len(ids), " ".join(map(numbers.__getitem__, ids)), " ".join(map(pieces.__getitem__, ids))))
    return pd.DataFrame(out, columns=["n_tokens", "ids_text", "decoded"])


def _with_ids(df: DataFrame, path: str, size: int, finish, fields: str) -> DataFrame:
    """doc_id and ``fields``, which ``finish`` makes of a chunk's documents with their ids."""
    kind = df.schema["doc_id"].dataType
    docs = df.select(F.col("doc_id").cast("string").alias("doc_id"), text_of().alias("text"))
    total = docs.agg(F.sum(F.char_length("text").cast("long"))).first()[0] or 0
    ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_CHARS))
    encoded = encode_words(word_lists(docs, ranges, size), path)
    found = (numbered(docs, ranges, size).groupBy("chunk").cogroup(encoded.groupBy("chunk"))
             .applyInPandas(lambda left, right: finish(_assemble(left, right)), f"doc_id string, {fields}"))
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))


def encode(df: DataFrame, path: str | None = None, size: int = CHUNK_CHARS) -> DataFrame:
    """doc_id and ``ids``, the packed ids of the text."""
    return _with_ids(df, path or wordcodec.vocabulary_path(), size, lambda rows: rows, "ids binary")


def decode(df: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_text (decimal ids) and decoded, from packed ``ids``."""
    path = path or wordcodec.vocabulary_path()

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in slices(batches, "ids", 1_000_000):
            yield _texts(b["ids"], path).assign(doc_id=b["doc_id"].to_numpy())[["doc_id", *TEXTS]]

    return map_documents(df.select("doc_id", "ids"), join, "n_tokens long, ids_text string, decoded string")


def round_trip(df: DataFrame, path: str | None = None, size: int = CHUNK_CHARS) -> DataFrame:
    """``decode`` of ``encode`` where the ids need not be kept: one pass over each chunk."""
    path = path or wordcodec.vocabulary_path()

    def finish(rows: pd.DataFrame) -> pd.DataFrame:
        return _texts(rows["ids"], path).assign(doc_id=rows["doc_id"])[["doc_id", *TEXTS]]

    return _with_ids(df, path, size, finish, "n_tokens long, ids_text string, decoded string")
