"""Whole texts to token ids, through the ``tokenizers`` library, with a cache of chunks.

A text is cut at single spaces.  The byte-level and the word-level BPE files that ``cuttable`` knows always end a
pre-token before a single space that stands between two visible characters, and BPE never looks across pre-tokens,
so the ids of the chunks, joined, are the ids of the text.  Texts for which that does not hold, and all texts under any other
tokenizer (another normalizer, pre-tokenizer or model, added tokens that a cut could hit), go whole through the library.

A column is encoded in slices of ``SLICE_BYTES`` (or one text, if that is longer).  Arrow cuts a slice and numbers its distinct
chunks, every distinct chunk is looked at once, and numpy gathers the ids of the texts:

* chunks of Latin letters, ASCII punctuation and single line ends are cut into their pre-tokens here, all at
  once; the distinct pre-tokens come from a cache, and the library's BPE model is asked for those that it lacks;
* another chunk whose first and last characters are plainly visible goes through
  the library's whole encoder;
* any other chunk (double spaces, a combining mark after a space, ...) is not
  cut out at all: its text is encoded whole.

Everything runs inside Spark tasks; the cache lives as long as its Python worker and
holds at most two generations of ``CACHE_PIECES`` entries: a full young generation
becomes the old one, and what is asked for again moves back.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_PIECES = 300_000
MAX_CACHED_CHARS = 64
SLICE_BYTES = 1 << 22
GATHER_IDS = 1 << 19

# Characters that are visible in every Unicode version: ASCII, Latin, Greek, Cyrillic, kana, CJK, Hangul.
_VISIBLE = "!-~À-ɏΑ-Ωα-ωЀ-ҁぁ-ゖァ-ヺ一-龥가-힣"
_SAFE = re.compile(f"(?:[{_VISIBLE}]|[{_VISIBLE}].*[{_VISIBLE}])", re.DOTALL)
# Latin letters and ASCII punctuation without the apostrophe (contractions) and "<" (special tokens);
# a line end only between two of them, where it is a pre-token of its own.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = r"!\"#$%&()*+,\-./:;=>?@\[\\\]^_`{|}~"
_SIMPLE = f"^[{_LETTERS}{_MARKS}]+(?:\n[{_LETTERS}{_MARKS}]+)*$"
_PIECE = f"( ?[{_LETTERS}]+| ?[{_MARKS}]+|\n)"
_CUT = "\0"  # stands between pre-tokens


def _byte_letters() -> dict[int, str]:
    """The visible letter that byte-level BPE writes for a byte that is not printable: from U+0100 on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return {b: chr(next(spare)) for b in range(256) if b not in printable}


# The settings under which cutting at single spaces was shown to keep the ids.
_PLAIN_BPE = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "fuse_unk": False, "ignore_merges": False}
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
_WORD_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def cuttable(kept: dict) -> str:
    """``bytes`` or ``words`` if a tokenizer of these settings may be asked for chunks, else nothing."""
    model, before = kept["model"], kept["pre_tokenizer"] or {}
    if any(model.get(k) != v for k, v in _PLAIN_BPE.items()) or kept["truncation"] or kept["padding"]:
        return ""
    for token in kept["added_tokens"]:  # such a token stands inside a chunk, and that chunk goes through the whole encoder
        if "<" not in token["content"] or re.search(r"\s", token["content"]) or token["lstrip"] or token["rstrip"] or token["single_word"]:
            return ""
    if kept["normalizer"] is None and before == {**_BYTE_LEVEL, "use_regex": True} and not model.get("end_of_word_suffix"):
        return "bytes"
    steps = before.get("pretokenizers", [{}])
    split = {"type": "Split", "pattern": {"Regex": _WORD_PATTERN}, "behavior": "Removed", "invert": True}
    if (before.get("type") == "Sequence" and steps == [split, {**_BYTE_LEVEL, "use_regex": False}] and model.get("end_of_word_suffix")
            and (kept["normalizer"] or {}).get("normalizers") == _WORD_NORMALIZERS):
        return "words"
    return ""


def strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


class PieceCache:
    """Two generations of at most ``CACHE_PIECES`` pre-tokens; ``make`` gives the missing values of a list."""

    def __init__(self, make):
        self.make, self.young, self.old = make, {}, {}

    def values(self, pieces: list[str]) -> list[bytes]:
        out, missing = [], []
        for i, piece in enumerate(pieces):
            value = self.young.get(piece)
            if value is None:
                value = self.old.get(piece)
                if value is None:
                    missing.append(i)
                else:
                    self._keep(piece, value)
            out.append(value)
        for i, value in zip(missing, self.make([pieces[i] for i in missing])):
            out[i] = value
            self._keep(pieces[i], value)
        return out

    def _keep(self, piece: str, value: bytes) -> None:
        if len(piece) <= MAX_CACHED_CHARS:
            if len(self.young) >= CACHE_PIECES:
                self.young, self.old = {}, self.young
            self.young[piece] = value


class Ragged:
    """Sequences of ids of different lengths in one array."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        self.ids, self.lengths = ids, lengths
        self.starts = np.cumsum(lengths) - lengths

    @classmethod
    def of(cls, values: list[bytes]) -> "Ragged":
        return cls(np.frombuffer(b"".join(values), dtype="<u4"), np.fromiter(map(len, values), np.int64, len(values)) // 4)

    def take(self, which: np.ndarray) -> "Ragged":
        """The chosen sequences, one after another."""
        lengths = self.lengths[which]
        shift = self.starts[which] - (np.cumsum(lengths) - lengths)
        return Ragged(self.ids[np.arange(int(lengths.sum())) + np.repeat(shift, lengths)], lengths)

    def joined(self, counts: np.ndarray) -> "Ragged":
        """Every ``counts`` sequences as one."""
        ends = np.append(0, np.cumsum(self.lengths))[np.cumsum(counts)]
        return Ragged(self.ids, np.diff(ends, prepend=0))

    def __add__(self, other: "Ragged") -> "Ragged":
        return Ragged(np.concatenate([self.ids, other.ids]), np.concatenate([self.lengths, other.lengths]))


class ChunkEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes; one per tokenizer file and worker."""

    _open: dict[str, "ChunkEncoder"] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = cuttable(json.loads(self.tokenizer.to_str()))
        self.lower = self.kind == "words"  # lower case, white space dropped
        self.model = self.tokenizer.model
        self.letters = {k: v for k, v in _byte_letters().items() if k}
        self.cache = PieceCache(self._pieces)

    @classmethod
    def get(cls, path: str) -> "ChunkEncoder":
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def encode_whole(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(x.ids, dtype="<u4").tobytes() for x in done]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of pre-tokens: their bytes as visible letters, then the BPE model."""
        if not pieces:
            return []
        shown = [""] * len(pieces)
        plain = [i for i, piece in enumerate(pieces) if piece.isascii()]  # visible but for the space and the line end
        for i, x in zip(plain, _CUT.join([pieces[i] for i in plain]).replace(" ", self.letters[32]).replace("\n", self.letters[10]).split(_CUT)):
            shown[i] = x
        other = [i for i, piece in enumerate(pieces) if not piece.isascii()]
        for i, x in zip(other, _CUT.join([pieces[i] for i in other]).encode().decode("latin-1").translate(self.letters).split(_CUT)):
            shown[i] = x
        tokenize = self.model.tokenize
        ids = [[] if self.lower and piece == "\n" else [t.id for t in tokenize(x)] for piece, x in zip(pieces, shown)]
        raw = np.array([i for some in ids for i in some], dtype="<u4").tobytes()
        ends = (np.cumsum([len(some) for some in ids]) * 4).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _chunks(self, chunks: pa.Array, lead: str) -> tuple[Ragged, list[int]]:
        """The ids of distinct chunks after ``lead``, and the numbers of those that cannot be encoded apart."""
        if not len(chunks):
            return Ragged.of([]), []
        simple = pc.match_substring_regex(chunks, _SIMPLE).to_numpy(zero_copy_only=False)
        kind = pa.large_string()
        led = pc.binary_join_element_wise(pa.scalar(lead, kind), chunks.filter(pa.array(simple)), pa.scalar("", kind))
        cut = pc.replace_substring_regex(pc.utf8_lower(led) if self.lower else led, _PIECE, r"\1" + _CUT)
        lists = pc.split_pattern(cut, _CUT)  # an empty string ends each list
        found = lists.values.filter(pc.not_equal(lists.values, "")).dictionary_encode()
        counts = np.diff(lists.offsets.to_numpy()) - 1
        pieces = Ragged.of(self.cache.values(strings(found.dictionary)))
        plain = pieces.take(found.indices.to_numpy()).joined(counts)
        odd = np.flatnonzero(~simple)
        others, apart = [], []
        for i, chunk in zip(odd.tolist(), strings(chunks.take(pa.array(odd)))):
            if _SAFE.fullmatch(chunk):
                others.append(lead + chunk)
            else:
                others.append("")
                apart.append(i)
        both = plain + Ragged.of(self.encode_whole(others) if others else [])
        order = np.empty(len(chunks), dtype=np.int64)
        order[np.append(np.flatnonzero(simple), odd)] = np.arange(len(chunks))
        return both.take(order), apart

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, no special tokens added."""
        return next(self.encode_column(pa.array([text], pa.string())))

    def encode_column(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each whole text of a column, null as empty, no special tokens added."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at, done = 0, 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
            some = pc.fill_null(texts.slice(at, stop - at), "").cast(pa.large_string())
            yield from self._slice(some) if self.kind else self.encode_whole(some.to_pylist())
            at, done = stop, int(ends[stop - 1])

    def _slice(self, texts: pa.Array) -> Iterator[bytes]:
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy()
        chunks = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
        offsets = offsets - offsets[0]
        heads = chunks.take(pa.array(offsets[:-1])).dictionary_encode()  # no space stands before the first chunk of a text
        later = chunks.dictionary_encode()
        values, apart = self._chunks(later.dictionary, "" if self.lower else " ")
        head_values, head_apart = self._chunks(heads.dictionary, "")
        codes = later.indices.to_numpy().copy()
        codes[offsets[:-1]] = heads.indices.to_numpy() + len(later.dictionary)
        apart += [len(later.dictionary) + i for i in head_apart]
        values += head_values
        whole = {}
        if apart:
            unsafe = np.flatnonzero(np.isin(codes, np.array(apart)))
            docs = np.unique(np.searchsorted(offsets, unsafe, side="right") - 1).tolist()
            whole = dict(zip(docs, self.encode_whole([texts[d].as_py() for d in docs])))
        sizes = np.append(0, np.cumsum(values.lengths[codes]))[offsets]  # ids before each text
        at = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(sizes, sizes[at] + GATHER_IDS, side="right")) - 1)
            raw = values.take(codes[offsets[at]:offsets[stop]]).ids.tobytes()
            cuts = ((sizes[at:stop + 1] - sizes[at]) * 4).tolist()
            for d, a, b in zip(range(at, stop), cuts, cuts[1:]):
                yield whole[d] if d in whole else raw[a:b]
            at = stop
