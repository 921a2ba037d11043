"""Packing of tokenised documents into training sequences.

Documents are tokenised whole and cut into pieces of at most a sequence; pieces go to random
groups of bounded size, and each group is packed by itself, first fit decreasing: pieces in
order of falling length, each into the first sequence with room, found in a tournament tree
of the room left.
"""

from __future__ import annotations

import os
import string
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .byte_bpe import Memo
from .texts import few_collections
from .texts import pieces as text_pieces

SEQUENCE = 2048
END_ID = 1
#: Rows of the document table per group, on average; a group's pieces fit one task easily.
GROUP_DOCS = 4096
MEMO = 600_000

#: Words of printable ASCII and of Latin letters, which composition leaves as they are.
_SIMPLE = regex.compile(r"[!-~¡-ɏ]+").fullmatch


class Words:
    """Token ids of a white-space separated word, as little-endian unsigned 32-bit bytes.

    The vocabulary's splitting drops white space and never joins across it, so a text's ids
    are its words' ids in order.  Simple words take the tokenizer's own steps one by one
    (lower case, split, byte alphabet, merges); any other word goes through it as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        splits = [p for p in _flat(self.tokenizer.pre_tokenizer) if p["type"] == "Split"]
        steps = [n["type"] for n in _flat(self.tokenizer.normalizer)]
        #: The steps above are those of this file; with other steps every word goes the long way.
        self.known = steps == ["NFC", "Replace", "Lowercase"] and len(splits) == 1
        self.split = regex.compile(splits[0]["pattern"]["Regex"]).findall if self.known else None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.alphabet = _byte_alphabet()
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.parts = Memo(self.part, MEMO)
        self.words = Memo(self.word, MEMO)

    def part(self, part: str) -> bytes:
        mapped = part if part.isascii() else part.encode().decode("latin-1").translate(self.alphabet)
        return b"".join([self.packed[t.id] for t in self.merge(mapped)])

    def word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        letters = text.rstrip(string.punctuation)
        lower = letters.lower()
        if self.known and lower.isalpha() and max(letters) <= "ɏ":  # letters, then perhaps a run of punctuation
            rest = text[len(letters) :]
            return self.parts[lower] + self.parts[rest] if rest else self.parts[lower]
        if self.known and _SIMPLE(text) and not any(s in text for s in self.special):
            return b"".join(map(self.parts.__getitem__, self.split(text.lower())))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, text.encode("utf-8", "replace").split()))


def _flat(component) -> list[dict]:
    import json

    state = json.loads(component.__getstate__())
    return state.get("normalizers") or state.get("pretokenizers") or [state]


def _byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(other)}


def cut(ids: bytes, length: int = SEQUENCE) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of the pieces of a document."""
    step = 4 * length
    return [(i // 4, len(p := ids[i : i + step]) // 4, zlib.crc32(p)) for i in range(0, len(ids), step)]


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def tokenise(docs: DataFrame, path: str, length: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece of each document: its place, length and the checksum of its ids."""
    last = end_id.to_bytes(4, "little")

    def run(batches):
        few_collections()
        words = Words(path)
        for batch in batches:
            for part in text_pieces(batch):
                rows = []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    ids = words.encode(text or "") + last
                    rows += [(doc, *p, len(ids) // 4) for p in cut(ids, length)]
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, StructType.fromDDL(_PIECES)
    )


def first_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, which must fall; first fit by a tournament tree.

    Leaf i holds the room left in bin i and each inner node the larger of its children, so the
    first bin with room is found from the root in one step per level.
    """
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    bins, offsets = [], []
    for length in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < length:
                node += 1
        bins.append(node - leaves)
        offsets.append(capacity - tree[node])
        tree[node] -= length
        while node > 1:
            node //= 2
            most = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == most:
                break
            tree[node] = most
    return bins, offsets


def pack(cut_pieces: DataFrame, groups: int, length: int = SEQUENCE) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces; sequences do not cross groups.

    A piece's group is a hash of all it holds, so repeated rows spread too, and equal rows
    that meet are interchangeable.
    """
    names = cut_pieces.columns
    schema = StructType([*cut_pieces.schema.fields, *StructType.fromDDL("sequence_id long, offset long").fields])
    order = [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]

    def run(table: pa.Table) -> pa.Table:
        group = table.column("_group")[0].as_py()
        table = table.select(names).sort_by(order)
        bins, offsets = first_fit(table.column("length").to_pylist(), length)
        table = table.append_column("sequence_id", pa.array([(group << 32) + b for b in bins], pa.int64()))
        return table.append_column("offset", pa.array(offsets, pa.int64()))

    group = F.pmod(F.xxhash64(*names), F.lit(groups)).alias("_group")
    return cut_pieces.select("*", group).groupBy("_group").applyInArrow(run, schema)


def pack_documents(docs: DataFrame, path: str, length: int = SEQUENCE, end_id: int = END_ID, group_docs: int = GROUP_DOCS) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``length`` ids.

    Null or empty text gives the end id alone; a long text gives as many pieces as it needs; a
    null ``doc_id`` stays null; repeated rows are packed each.  The number of groups follows
    the number of rows, so a group's size does not grow with the data.  The texts are read
    once; only the pieces' numbers are shuffled.
    """
    groups = max(1, -(-docs.count() // group_docs))
    return pack(tokenise(docs, path, length, end_id), groups, length)
