"""SentencePiece ids and texts by tables of distinct chunks.

A piece of the model never holds a white space marker after another character, so no piece crosses the
place where a marker follows one, nor a line end that no piece holds. Texts are cut there. Each block of
texts gets a table of its distinct chunks, the sentencepiece library segments each of them once, and the
ids are joined back by place. Blocks are slices of a task's rows: no text and no chunk is shuffled, for moving a
chunk between machines takes longer than to segment it again in another block.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.batches import slices

MARK = "▁"
WINDOW = 1 << 20  # characters of a text that are cut into chunks at once


def public_model(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """A model whose pieces do not cross markers: its chunks, their ids, and the text of ids."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.library.get_piece_size())
        pieces = [self.library.id_to_piece(i) for i in ids]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("pieces of this model cross white space markers")
        self.bos, self.eos = self.library.bos_id(), self.library.eos_id()
        # A line end is a cut if it is always a byte of its own after the marker that opens a text.
        opening, line_end = self.library.piece_to_id(MARK), self.library.piece_to_id("<0x0A>")
        self.cuts_lines = not any("\n" in p for p in pieces) and self.library.encode("\n") == [opening, line_end]
        self.opening = opening
        self.chunk = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if self.cuts_lines else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.cut = re.compile(f"[^{MARK}]{MARK}")
        if self.library.encode(" a  b") != [*self._after_opening("▁a"), *self._plain("▁▁b")]:
            raise ValueError("this model changes texts before it segments them")
        self.surface = [self._surface(i, p) for i, p in zip(ids, pieces)]

    def _plain(self, chunk: str) -> list[int]:
        return self.library.encode(chunk[1:])

    def _after_opening(self, chunk: str) -> list[int]:
        return self.library.encode(" " + chunk[1:])

    def _surface(self, i: int, piece: str) -> bytes:
        if self.library.is_control(i):
            return b""
        if self.library.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        if self.library.is_unknown(i):
            return " ⁇ ".encode()
        return piece.replace(MARK, " ").encode()

    def chunks(self, text: str, window: int = WINDOW) -> Iterator[list[str]]:
        """The chunks of a text with its markers, one before the text and one for each space, window by window."""
        marked = MARK + text.replace(" ", MARK) if text else ""
        at = 0
        while at < len(marked):
            cut = self.cut.search(marked, at + window)
            end = cut.start() + 1 if cut else len(marked)
            yield self.chunk.findall(marked, at, end)
            at = end

    def segment(self, chunks: list[str]) -> list[list[int]]:
        """The ids of each chunk. The library puts a marker before what it gets; the chunk's first one, or for
        a chunk without one a marker and a line end, which are cut off again."""
        marked = [c[0] == MARK for c in chunks]
        found = self.library.encode([c[1:] if m else "\n" + c for c, m in zip(chunks, marked)], num_threads=1)
        # The library gives no ids for nothing at all: a lone marker.
        return [(ids or [self.opening]) if m else ids[2:] for ids, m in zip(found, marked)]

    def text(self, ids: list[int]) -> str:
        """What the library's decode gives: surfaces in a row without the space of the marker before the text.

        A space that a byte piece stands for is no marker and stays."""
        surface = self.surface
        raw = b"".join([surface[i] for i in ids])
        first = next((i for i in ids if i not in (self.bos, self.eos)), None)
        if first is not None and raw[:1] == b" " and not (self.library.is_unknown(first) or self.library.is_byte(first)):
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:  # bytes that no text has; the library says what they become
            return self.library.decode(ids)


_pieces: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The model of this worker process."""
    if path not in _pieces:
        os.environ.setdefault("OMP_NUM_THREADS", "1")
        _pieces[path] = Pieces(path)
    return _pieces[path]


class _Places(dict):
    """Places of distinct values in the order in which they came."""

    def __missing__(self, value):
        place = self[value] = len(self)
        return place


def block_ids(model: Pieces, texts: list[str | None]) -> list[bytes]:
    """The ids of every text, little-endian unsigned 32-bit, by one table of all the texts' distinct chunks."""
    table = _Places()
    places = []
    for text in texts:
        found = [np.fromiter(map(table.__getitem__, part), "<u4", len(part)) for part in model.chunks(text or "")]
        places.append(np.concatenate(found) if found else np.zeros(0, "<u4"))
    segmented = [np.array(ids, "<u4").tobytes() for ids in model.segment(list(table))]
    first, last = (np.array([x], "<u4").tobytes() for x in (model.bos, model.eos))
    made = []
    for at in places:
        parts = [b"".join([segmented[p] for p in at[i : i + WINDOW].tolist()]) for i in range(0, len(at), WINDOW)]
        made.append(b"".join([first, *parts, last]))
    return made


def encode(docs: DataFrame, path: str | None = None, block_chars: int = 2_000_000) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit): every text with begin and end ids.

    A null text is empty, and an empty text has the begin and end ids alone; repeated rows and null or
    repeated doc_ids are rows of their own; other columns are ignored. Every text is cut whole: a block holds
    at most `block_chars` characters or one longer text, so its table of distinct chunks is as bounded.
    """
    path = path or public_model()
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch, texts in slices(batches, "text", block_chars):
            made = block_ids(model, texts)
            counts = pa.array([len(x) // 4 for x in made], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), counts, pa.array(made, pa.binary())], ["doc_id", "n_tokens", "ids"])

    return docs.select("doc_id", "text").mapInArrow(ids_of, f"doc_id {id_type}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Adds `text`: what the ids of each row stand for, as the library decodes them."""
    path = path or public_model()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("ids"))
            for at in range(0, batch.num_rows, 64):
                part = column.slice(at, 64)
                made = [None if x is None else model.text(np.frombuffer(x, "<u4").tolist()) for x in part.to_pylist()]
                piece = batch.slice(at, 64)
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(made, pa.string())], [*piece.schema.names, "text"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(texts, f"{fields}, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Number and SHA-256 of every document's ids, and SHA-256 of the text decoded from them."""
    rows = decode(encode(docs, path), path)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))
