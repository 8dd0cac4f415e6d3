"""SentencePiece encoding and decoding by a table of distinct chunks.

No piece of a model holds a whitespace marker after another character, so merges never
cross from one marked word to the next. A chunk is a run of markers and the word behind
it; each task segments a distinct chunk once, keeps its ids and what they decode to in a
table, and joins them back by position. Tasks share nothing and nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stockledger.llm.shared import as_bytes

MARKER = "▁"

# Characters of chunks a task keeps in its table before it starts a new one.
TABLE_CHARS = 20_000_000

_RUNS = re.compile(" +[^ ]*")


@lru_cache(maxsize=2)
def processor(model: str):
    """The model of a worker process. It fails if the model does not suit chunks."""
    import sentencepiece

    loaded = sentencepiece.SentencePieceProcessor(model_file=model)
    for i in range(loaded.get_piece_size()):
        if MARKER in loaded.id_to_piece(i).lstrip(MARKER):
            raise ValueError(f"piece {i} crosses a whitespace marker; encode whole texts instead")
    return loaded


class ChunkTable(dict):
    """Chunk (one or more spaces, then a word) to (number of ids, ids as text, decoded text)."""

    def __init__(self, model: str):
        super().__init__()
        self.model, self.held = processor(model), 0
        self.marker = self.model.piece_to_id(MARKER)

    def ids(self, chunk: str) -> list[int]:
        # The library puts one marker in front of any text but the empty one.
        return self.model.encode(chunk[1:], num_threads=1) if len(chunk) > 1 else [self.marker]

    def __missing__(self, chunk: str) -> tuple[int, str, str]:
        ids = self.ids(chunk)
        # Decoding drops the first marker, and each chunk begins with one.
        found = self[chunk] = (len(ids), " ".join(map(str, ids)), " " + self.model.decode(ids))
        self.held += len(chunk) + 64
        return found

    def trim(self) -> None:
        if self.held > TABLE_CHARS:
            self.clear()
            self.held = 0


def chunks(text: str) -> list[str]:
    """The chunks of a text in order; the library's own marker in front is the first one's space."""
    if not text:
        return []
    spaced = " " + text.replace(MARKER, " ")
    if "  " not in spaced and spaced[-1] != " ":
        return [" " + word for word in spaced[1:].split(" ")]
    return _RUNS.findall(spaced)


def encode_decode(docs: DataFrame, model: str, key: str = "doc_id", keep_texts: bool = False) -> DataFrame:
    """Per row its key, n_tokens, ids_sha256 and decoded_sha256; ids and decoded text on request.

    Ids are those of the library for the whole text, and the model's end id. A null text is
    empty: it has the end id only and decodes to nothing. Repeated rows give repeated rows;
    other columns of ``docs`` do not matter. A very long text is cut into its chunks like any other; what is held of it
    besides its ids is the table, which is bounded.
    """
    fields = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if keep_texts:
        fields += ", ids array<int>, decoded string"
    key_field = T.StructField(key, docs.schema[key].dataType)
    schema = T.StructType([key_field, *T.StructType.fromDDL(fields).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(model)
        end = table.model.eos_id()
        for batch in batches:
            out: list[list] = [[] for _ in schema.fields[1:]]
            for value in batch.column("text"):
                found = list(map(table.__getitem__, chunks(value.as_py().decode("utf-8", "replace"))))
                ids = " ".join([*(x[1] for x in found), str(end)])
                decoded = "".join([x[2] for x in found])[1:]
                row = [
                    sum(x[0] for x in found) + 1,
                    hashlib.sha256(ids.encode()).hexdigest(),
                    hashlib.sha256(decoded.encode()).hexdigest(),
                ]
                if keep_texts:
                    row += [list(map(int, ids.split(" "))), decoded]
                for column, x in zip(out, row):
                    column.append(x)
                table.trim()
            types = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string()]
            arrays = [pa.array(x, t) for x, t in zip(out, types)]
            yield pa.RecordBatch.from_arrays([batch.column(key), *arrays], names=schema.names)

    return as_bytes(docs, key).mapInArrow(run, schema)
