"""Token ids of texts by a public tokenizer file, with a bounded memory of pieces already seen.

The byte-level pattern of the tokenizer never lets a token reach across a single space that stands
between two characters that are not white space: the space opens a token. So does a single line feed
there, and so do full stops, commas and the like that end a piece after a letter or digit. So a text is
cut at these places, the distinct pieces of a slice are found by Arrow, those that were seen before are
looked up, and only new ones are given to the tokenizers library, joined to longer strings. New pieces of
letters alone are one word each to the pattern, so they are joined and given to the library's byte-level
model without the pattern. The ids are those of encoding the whole text, special tokens included.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CUT = re.compile(r"(?<=\S) (?=\S)")
# White space but the space and the line feed.
_ODD = [c for c in map(chr, range(0x110000)) if c.isspace() and c not in " \n"]
# Digits and letters of long standing, of which every version of Unicode says so.
_LETTERS = ("AZ", "az", "ÀÖ", "Øö", "øʯ", "Ѐҁ", "αω", "一龥")
_SURE = pa.array([chr(c) for a, b in ("09", *_LETTERS) for c in range(ord(a), ord(b) + 1)], pa.large_string())
_WORD = re.compile("[" + "".join(f"{a}-{b}" for a, b in _LETTERS) + "]+")
_WORDS = re.compile(f"(?: {_WORD.pattern})+")


def _without_pattern(library):
    """A tokenizer of the same model that gives the same ids for words of letters, each after a space; None if there is none.

    Each such word is one piece of the pattern. Nothing changes without it if no token reaches from a word into the
    next one. Tokens with the first byte of "Â" do not occur, as none of these letters has it.
    """
    from tokenizers import Tokenizer, models, pre_tokenizers

    split, model = library.pre_tokenizer, library.model
    by_pattern = isinstance(split, pre_tokenizers.ByteLevel) and split.use_regex and not split.add_prefix_space
    if library.normalizer is not None or not by_pattern or not isinstance(model, models.BPE):
        return None
    if any(x is not None for x in (model.dropout, model.unk_token, model.continuing_subword_prefix, model.end_of_word_suffix)) or model.ignore_merges:
        return None
    if any(_WORD.fullmatch(x.content.replace(" ", "")) for x in library.get_added_tokens_decoder().values()):
        return None
    if any("Â" not in x and re.search("[^Ġ]Ġ", x) for x in library.get_vocab()):
        return None
    found = Tokenizer(model)
    found.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return found


class Encoder:
    """Encodes texts as little-endian unsigned 32-bit ids; remembers at most `most_pieces` pieces."""

    def __init__(self, path: str, most_pieces: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.seen: dict[str, bytes] = {}
        self.most = most_pieces
        size = self.library.get_vocab_size()
        known = [self.library.id_to_token(i) or "" for i in range(size)]
        self.opens = {mark: np.array([x.startswith(byte) for x in known]) for mark, byte in ((" ", "Ġ"), ("\n", "Ċ"))}
        self.words = _without_pattern(self.library)
        self.tails: dict[str, bytes] = {}
        special = "".join(x.content for x in self.library.get_added_tokens_decoder().values())
        self.marks = "".join(c for c in ".,;:!?" if c not in special)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        by = self.words if self.words is not None and all(map(_WORDS.fullmatch, texts)) else self.library
        return [np.array(x.ids, "<u4") for x in by.encode_batch_fast(texts, add_special_tokens=False)]

    def _new(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces; one that begins with a line feed is taken as it is, others after a space."""
        found: list[bytes] = [b""] * len(pieces)
        alone, words, spaced, lines = [], [], [], []
        for i, p in enumerate(pieces):
            if _WORD.fullmatch(p):
                words.append(i)
            elif " " in p or p == "\n":
                alone.append(i)
            else:
                (lines if p[:1] == "\n" else spaced).append(i)
        # The model takes longer for each word of a long string.
        for mark, places, most in ((" ", words, 100), (" ", spaced, 1000), ("\n", lines, 1000)):
            for first in range(0, len(places), most):
                part = places[first : first + most]
                # Pieces after a line feed begin with it themselves.
                glue = " " if mark == " " else ""
                ids = self._whole([glue + glue.join([pieces[i] for i in part])])[0]
                starts = np.flatnonzero(self.opens[mark][ids]) * 4
                raw = ids.tobytes()
                for i, a, b in zip(part, starts.tolist(), [*starts[1:].tolist(), len(raw)]):
                    found[i] = raw[a:b]
        if alone:
            for i, ids in zip(alone, self._whole([pieces[i] if pieces[i] == "\n" else " " + pieces[i] for i in alone])):
                found[i] = ids.tobytes()
        return found

    def _looked_up(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces; only those not seen before are given to the library."""
        texts = pieces.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.seen.get, texts))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            fresh = [texts[i] for i in missing]
            new = self._new(fresh)
            if len(self.seen) < self.most:
                self.seen.update(zip(fresh, new))
            for i, ids in zip(missing, new):
                found[i] = ids
        return pa.array(found, pa.large_binary())

    def _tail(self, tail: str) -> bytes:
        """Ids of marks that end a piece."""
        if tail not in self.tails:
            ids = self._whole([tail])[0].tobytes()
            if len(self.tails) >= self.most:
                return ids
            self.tails[tail] = ids
        return self.tails[tail]

    def _distinct(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces: of the piece without the marks at its end, then of the marks."""
        cores = pc.utf8_rtrim(pieces, characters=self.marks)
        cores = pc.if_else(pc.is_in(pc.utf8_slice_codeunits(cores, start=-1), _SURE), cores, pieces)
        lengths = pc.subtract(pc.binary_length(pieces), pc.binary_length(cores)).to_numpy(zero_copy_only=False)
        coded = cores.dictionary_encode()
        ids = self._looked_up(coded.dictionary).take(coded.indices)
        ended = np.flatnonzero(lengths)
        if not len(ended):
            return ids
        tails = np.full(len(pieces), b"", object)
        tails[ended] = [self._tail(p[-n:]) for p, n in zip(pieces.take(pa.array(ended)).to_numpy(zero_copy_only=False), lengths[ended].tolist())]
        return pc.binary_join_element_wise(ids, pa.array(tails, pa.large_binary()), pa.scalar(b"", pa.large_binary()))

    def _joined(self, cut: pa.ListArray) -> list[bytes]:
        """Ids of texts that are cut into pieces."""
        ends = cut.offsets.to_numpy()
        flat = cut.values
        # The first piece of a text has no space before it.
        heads = [x.tobytes() for x in self._whole(flat.take(pa.array(ends[:-1])).to_pylist())]
        inner = np.ones(len(flat), bool)
        inner[ends[:-1]] = False
        coded = flat.filter(pa.array(inner)).dictionary_encode()
        ids = self._distinct(coded.dictionary).take(coded.indices)
        # The ids of all texts lie one after the other, without their heads.
        sums = np.concatenate(([0], np.cumsum(pc.binary_length(ids).to_numpy(zero_copy_only=False))))
        bounds = sums[ends - np.arange(len(ends))].astype(np.int64).tolist()
        raw = memoryview(ids.buffers()[2] or b"")
        return [head + raw[a:b] for head, a, b in zip(heads, bounds, bounds[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        simple, other = [], []
        for i, text in enumerate(texts):
            odd = any(c in text for c in _ODD) or "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " "
            (other if odd else simple).append(i)
        found: list[bytes] = [b""] * len(texts)
        if simple:
            # A single line feed opens a piece too.
            lines = [texts[i] if "\n\n" in texts[i] else texts[i].replace("\n", " \n") for i in simple]
            cut = pc.split_pattern(pa.array(lines, pa.large_string()), " ")
            for i, ids in zip(simple, self._joined(cut)):
                found[i] = ids
        if other:
            cut = pa.array([_CUT.split(texts[i]) for i in other], pa.list_(pa.large_string()))
            for i, ids in zip(other, self._joined(cut)):
                found[i] = ids
        return found


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this worker process for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def public_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
