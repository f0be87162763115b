"""SentencePiece encoding and decoding with a table of distinct chunks.

A chunk is a run of white-space markers and what follows up to the next run. If no piece of the model has
a marker after another character, no piece crosses from one chunk to the next, so the text's ids are its
chunks' ids in order: each distinct chunk of a batch is segmented once, and its ids are joined back by
position. The table lives in the task that reads the texts; nothing is shuffled, as a table of all words
of the corpus would have to move every word of every text. A table beyond TABLE_CHUNKS entries is emptied
and filled anew, which changes no result. For a model with crossing pieces, or one whose normalizer does
more than mark blanks, whole texts are encoded.

Defined cases: a null text is encoded as an empty one, which has only the begin and end ids. Very long texts
are encoded whole, in the task that reads them. Repeated rows each get their own result. Columns named in keep
are passed through; one with the name of a result has `_in` put after its name. Other columns are never read. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
TABLE_CHUNKS = 200_000
#: Longer chunks are segmented each time they come, so that the table's size stays bounded.
TABLE_CHARS = 64
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class PieceCodec:
    """Encodes and decodes as the library does, through the table where the model allows it."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor()
        self.library.LoadFromSerializedProto(model)
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        self.table: dict[str, tuple[int, ...]] = {}
        pieces = (self.library.id_to_piece(i) for i in range(self.library.get_piece_size()))
        self.chunked = not any(MARK in p.lstrip(MARK) for p in pieces) and all(self._plain(t) for t in ("a  b ", " Åﬁ\n\tz", "² 　x"))

    def _plain(self, text: str) -> bool:
        return self.library.normalize(text) == MARK + text.replace(" ", MARK)

    def _segment(self, chunk: str) -> tuple[int, ...]:
        # The library puts a marker before a text, which stands for the chunk's first.
        return tuple(self.library.encode(chunk[1:].replace(MARK, " "))) if len(chunk) > 1 else (self.library.piece_to_id(MARK),)

    def _ids(self, chunk: str) -> tuple[int, ...]:
        ids = self.table.get(chunk)
        if ids is None:
            ids = self._segment(chunk)
            if len(chunk) <= TABLE_CHARS:
                if len(self.table) >= TABLE_CHUNKS:
                    self.table.clear()
                self.table[chunk] = ids
        return ids

    def encode(self, text: str) -> array:
        """All ids, begin and end included."""
        if not text:
            return array("I", [self.begin, self.end])
        if not self.chunked:
            return array("I", [self.begin, *self.library.encode(text), self.end])
        chunks = _CHUNK.findall(MARK + text.replace(" ", MARK))
        return array("I", chain((self.begin,), chain.from_iterable(map(self._ids, chunks)), (self.end,)))

    def decode(self, ids: array) -> str:
        return self.library.decode(ids.tolist())


#: Results by name, and their types.
RESULTS = {"n_tokens": "long", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", results: tuple[str, ...] = ("ids", "decoded"), keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns of keep, and the wanted results: begin and end are among the ids, digests are SHA-256."""
    if unknown := set(results) - set(RESULTS):
        raise ValueError(f"no such results: {sorted(unknown)}")
    model = docs.sparkSession.sparkContext.broadcast(_read(model_path))
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    passed = {c: f"{c}_in" if c in results else c for c in keep if c != id_col}
    names = ["doc_id", *passed.values(), *results]
    make = {
        "n_tokens": lambda ids, texts: pa.array([len(x) for x in ids], pa.int64()),
        "ids": lambda ids, texts: pa.array([x.tolist() for x in ids], pa.list_(pa.int32())),
        "decoded": lambda ids, texts: pa.array(texts, pa.string()),
        "ids_sha256": lambda ids, texts: pa.array([_little(x) for x in ids], pa.string()),
        "decoded_sha256": lambda ids, texts: pa.array([hashlib.sha256(x.encode()).hexdigest() for x in texts], pa.string()),
    }
    decodes = any(x.startswith("decoded") for x in results)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(model.value)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                ids = [codec.encode(x or "") for x in part.column(1).to_pylist()]
                texts = [codec.decode(x) for x in ids] if decodes else []
                yield pa.RecordBatch.from_arrays([part.column(0), *part.columns[2:], *(make[x](ids, texts) for x in results)], names=names)

    schema = [f"doc_id {kinds[id_col]}", *(f"`{name}` {kinds[c]}" for c, name in passed.items()), *(f"{x} {RESULTS[x]}" for x in results)]
    columns = [F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *(F.col(c).alias(f"c{k}") for k, c in enumerate(passed))]
    return docs.select(*columns).mapInArrow(run, ", ".join(schema))


def _little(ids: array) -> str:
    import sys

    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return hashlib.sha256(ids.tobytes()).hexdigest()
