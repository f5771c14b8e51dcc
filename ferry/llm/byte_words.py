"""Encoding with a byte-level BPE vocabulary of the tokenizers library, word by
word.

The vocabulary's pre-tokeniser starts a new part at every space that follows a
character other than white space, so the ids of a text are those of its parts
in a row; parts are encoded once by the library and remembered, by a worker, in
two generations bounded by bytes. Long parts are not remembered. ``ByteWords``
tests its vocabulary for that property and refuses another.

A column of texts is cut by Arrow, and each of its distinct pre-tokens goes to
the library's model once, many in a call, with a byte between them that no merge
takes: merges stay inside a pre-token, and the byte's id tells where each ends.
No object is made for a word. Words with other letters than Latin ones, and those
at a run of white space, are encoded one by one, as above.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ferry.llm.common import worker_cache

# Bytes of a generation of remembered parts, as Python holds them, about.
CACHE_BYTES = 80 << 20
ENTRY_BYTES = 250
# Characters from which a part is not remembered.
LONG = 64
# Words of a text between two looks at the bound.
SLICE = 50_000
# Pre-tokens that the model gets at a time: one call for many, and a short queue of merges.
TOGETHER = 16
# Words of a column cut, encoded or put in a row at a time.
GATHER = 1 << 18
# ASCII marks that never join a Latin letter before them in one pre-token.
TAIL = ".,;:!?&$%*#|"

# Zero-width places where a text can be cut whatever follows.
_CUT = re.compile(r"(?<=\S)(?= )")
_RUN = re.compile(r"\s ")
# Latin letters after one space or none: a pre-token whatever the Unicode version.
_LATIN = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿĀ-ɏ]+")
# Fixed value: the pre-tokens of byte-level BPE, for ASCII text.
_ASCII = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII
)
# The same for text of ASCII characters and Latin letters only.
_MIXED = re.compile(_ASCII.pattern.replace("A-Za-z", "A-Za-zÀ-ÖØ-öø-ÿĀ-ɏ"), re.ASCII)
# Texts of these, for Arrow; and words without white space (as Python sees it) at either end.
_PLAIN_TEXT = "^[\\x{00}-\\x{7F}À-ÖØ-öø-ÿĀ-ɏ]*$"
_END = "[\\x{00}-\\x{08}\\x{0E}-\\x{1B}\\x{21}-\\x{7F}À-ÖØ-öø-ÿĀ-ɏ]"
_PLAIN_WORD = f"^{_END}$|^{_END}{_PLAIN_TEXT[1:-1]}{_END}$"

# Fixed value: printable bytes stand for themselves, the others for the
# characters from U+0100 on, in order.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_CHARACTER = {b: b for b in _PLAIN} | {b: 0x100 + k for k, b in enumerate(sorted({*range(256)} - {*_PLAIN}))}

_SPACE = chr(_CHARACTER[0x20])
_TABLE = np.array([_CHARACTER[b] for b in range(256)], dtype="<u4")
# A byte that is in no UTF-8 text; it stands for itself.
_BETWEEN = 0xFF


class _Words(dict):
    """Ids of a space and the key, as little-endian unsigned 32-bit integers."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode, self.older, self.long, self.held = encode, {}, [], 0

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = self.encode(part)
        self[part] = ids
        self.held += ENTRY_BYTES + len(part) + len(ids)
        if len(part) >= LONG:
            self.long.append(part)
        return ids

    def bound(self) -> None:
        """Forget long parts; past the bound, the generation becomes the older one."""
        for part in self.long:
            self.pop(part, None)
        self.long.clear()
        if self.held > CACHE_BYTES:
            self.older, self.held = dict(self), 0
            self.clear()


class ByteWords:
    """``special``: whether the special tokens' strings in a text are those tokens."""

    def __init__(self, path: str, special: bool) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.model = self.tokenizer.model.tokenize
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content for t in added.values()] if special else []
        self.words = _Words(self._word)
        self.atoms = _Words(self._atom)
        self.between = self._between()
        self._check()

    def _check(self) -> None:
        for text in ("it's a <tag> 12a, é!", "\na b  c \n d\t e", " 'tis   x ..", "a\x1c b\x85 c"):
            if b"".join(map(self.library, _CUT.split(text))) != self.library(text):
                raise ValueError("this vocabulary does not start a part at a space")
        if self.library(" don't,\n\n(12ab)") != b"".join(map(self.library, _ASCII.findall(" don't,\n\n(12ab)"))):
            raise ValueError("this vocabulary cuts ASCII text in another way")
        if self.library(" Été.,") != self.library(" Été") + self.library(".,"):
            raise ValueError("this vocabulary does not cut letters from marks")
        for a in (" the", " Été", ",", "'s", "\n\n", " 12"):
            if self._one(a) != self.library(a):
                raise ValueError("this vocabulary does not encode a part by its bytes")

        some = [" the", " Été", ",", "'s", "\n\n", " 12", "x", "The"]
        if self._together(pa.array(some))[0].tobytes() != b"".join(map(self._one, some)):
            raise ValueError("this vocabulary does not encode parts together")
        mixed = " l'Été.\n\nÈx'll,ñ12 ?é"
        if self.library(mixed) != b"".join(map(self.library, _MIXED.findall(mixed))):
            raise ValueError("this vocabulary cuts Latin text in another way")

    def _between(self) -> int | None:
        """The id of the byte between parts, if no merge takes it and parts in a row are encoded as alone."""
        model, mark = self.tokenizer.model, chr(_BETWEEN)
        odd = (model.dropout, model.ignore_merges, model.continuing_subword_prefix, model.end_of_word_suffix)
        holders = [t for t in self.tokenizer.get_vocab(with_added_tokens=False) if mark in t]
        return self.tokenizer.token_to_id(mark) if holders == [mark] and not any(odd) else None

    def library(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return array("I", found[0].ids).tobytes()

    def _one(self, part: str) -> bytes:
        """Ids of one pre-token, by the library's model."""
        return array("I", [t.id for t in self.model(part.encode().decode("latin-1").translate(_CHARACTER))]).tobytes()

    def _atom(self, part: str) -> bytes:
        return self._one(part) if part.isascii() or _LATIN.fullmatch(part) else self.library(part)

    def _word(self, word: str) -> bytes:
        plain = word.isascii()
        if plain and word.isalpha():
            return array("I", [t.id for t in self.model(_SPACE + word)]).tobytes()
        core = word.rstrip(TAIL)
        if core != word and (core.isalpha() if plain else _LATIN.fullmatch(core)):
            return self.words[core] + self.atoms[word[len(core) :]]
        part = " " + word
        if not plain:
            return self._atom(part)
        return b"".join(map(self.atoms.__getitem__, _ASCII.findall(part)))

    def encode(self, text: str) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit integers."""
        if any(s in text for s in self.special):
            return self.library(text)
        if "  " in text or _RUN.search(text):
            head, *words = _CUT.split(text)
            words = [w[1:] for w in words]
        else:
            head, *words = text.split(" ")
        out = [self.library(head)] if head else []
        for at in range(0, len(words), SLICE):
            out.append(b"".join(map(self.words.__getitem__, words[at : at + SLICE])))
            self.words.bound()
            self.atoms.bound()
        return b"".join(out)

    def _together(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pre-tokens in a row, by the library's model, and how many each has."""
        if self.between is None or not len(parts):
            return _row([self._one(p) for p in parts.to_pylist()])
        bounds, data = _buffers(parts)
        text = _TABLE[np.insert(data, bounds[1:], _BETWEEN)].tobytes().decode("utf-32-le")
        ends = (bounds[1:] + np.arange(1, len(bounds))).tolist()
        cuts, found = [0, *ends[TOGETHER - 1 : -1 : TOGETHER], ends[-1]], array("I")
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            found.extend([t.id for t in self.model(text[a:b])])
        ids = np.frombuffer(found, dtype="<u4")
        ends = np.flatnonzero(ids == self.between)
        if len(ends) != len(parts):
            raise ValueError("the byte between parts was merged")
        return ids[ids != self.between], np.diff(ends, prepend=-1) - 1

    def _parts(self, words: pa.Array, heads: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain words, each after a space, and then of plain heads, without
        one, in a row; and how many each has."""
        cut, n = [], [np.zeros(0, dtype=np.int64)]
        for at in range(0, len(words), GATHER):
            some = pa.array(_MIXED.findall(" " + _joined(words.slice(at, GATHER))))
            bounds, data = _buffers(some)
            n.append(np.diff(np.append(np.flatnonzero(data[bounds[:-1]] == 0x20), len(some))))  # a word starts at a space
            cut.append(some)
        for at in range(0, len(heads), GATHER):
            some = list(map(_MIXED.findall, heads.slice(at, GATHER).to_numpy(zero_copy_only=False).tolist()))
            n.append(np.fromiter(map(len, some), dtype=np.int64, count=len(some)))
            cut.append(pa.array([p for parts in some for p in parts], pa.string()))
        parts = pa.concat_arrays([c.cast(pa.string()) for c in cut] or [pa.array([], pa.string())]).dictionary_encode()
        found = [self._together(parts.dictionary.slice(at, GATHER)) for at in range(0, max(1, len(parts.dictionary)), GATHER)]
        row, size = (np.concatenate(x) for x in zip(*found, strict=True))
        index, n = parts.indices.to_numpy(), np.concatenate(n)
        upto = np.append(0, np.cumsum(size[index]))
        ends = np.cumsum(n)
        return _gather(row, size, index), upto[ends] - upto[ends - n]

    def _each(self, texts: pa.Array, plain: np.ndarray, one) -> list[bytes]:
        """Ids of the texts that are not plain, by ``one``."""
        out = []
        for text in texts.filter(pa.array(~plain)).to_numpy(zero_copy_only=False).tolist():
            out.append(one(text))
            if len(out) % SLICE == 0:
                self.bound()
        self.bound()
        return out

    def bound(self) -> None:
        self.words.bound()
        self.atoms.bound()

    def column(self, texts: pa.Array, end: bytes = b"", kind: str = "<u4") -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts (null: empty) in a row, each text's followed by those of
        ``end``, as ``kind``; and how many each text has, with them."""
        texts = texts.fill_null("")
        if not len(texts):
            return np.zeros(0, dtype=kind), np.zeros(0, dtype=np.int64)
        split = pc.split_pattern(texts, " ")
        bounds, words = split.offsets.to_numpy().astype(np.int64), split.values
        heads = words.take(pa.array(bounds[:-1]))
        words = words.dictionary_encode()
        index, words = words.indices.to_numpy(), words.dictionary
        plain = _matches(words, _PLAIN_WORD)
        # texts with a special token, or a run of white space inside, are encoded one by one
        loose = np.zeros(len(words), dtype=bool)
        loose[~plain] = [not w or w[-1].isspace() for w in words.filter(pa.array(~plain)).to_numpy(zero_copy_only=False).tolist()]
        at = np.flatnonzero(loose[index])
        text = np.searchsorted(bounds, at, side="right") - 1
        alone = np.zeros(len(texts), dtype=bool)
        alone[text[at < bounds[text + 1] - 1]] = True
        for token in self.special:
            alone |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        plain_head = _matches(heads, _PLAIN_TEXT) & ~alone
        # rows of ids: of plain words and heads, other words, other heads and whole texts, the end
        row, size = self._parts(words.filter(pa.array(plain)), heads.filter(pa.array(plain_head)))
        other = self._each(words, plain, self.words.__getitem__)
        starts = pc.if_else(pa.array(alone), texts, heads)
        other += self._each(starts, plain_head, self.encode)
        more, sizes = _row([*other, end])
        row, size = np.concatenate([row, more]).astype(kind), np.concatenate([size, sizes])
        number = np.empty(len(words) + len(texts), dtype=np.int32)
        first = np.append(plain, plain_head)
        k = int(plain.sum())
        number[np.flatnonzero(plain)] = np.arange(k)
        number[len(words) + np.flatnonzero(plain_head)] = np.arange(k, first.sum())
        number[~first] = np.arange(first.sum(), len(first))
        index = number[index]
        index[bounds[:-1]] = number[len(words) :]
        if alone.any():
            inside = np.repeat(alone, np.diff(bounds))
            inside[bounds[:-1]] = False
            bounds = np.append(0, np.cumsum(~inside))[bounds]
            index = index[~inside]
        index = np.insert(index, bounds[1:], len(size) - 1)
        n = np.add.reduceat(size[index], bounds[:-1] + np.arange(len(texts)))
        return _gather(row, size, index), n


def _matches(texts: pa.Array, pattern: str) -> np.ndarray:
    return pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).astype(bool)


def _joined(words: pa.Array) -> str:
    """The words with a space between them."""
    all_words = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string()))
    return pc.binary_join(all_words, " ")[0].as_py()


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and bytes of texts without nulls."""
    _, bounds, data = texts.cast(pa.string()).buffers()
    bounds = np.frombuffer(bounds, dtype="<i4")[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype="u1") if data is not None else np.zeros(0, dtype="u1")
    return bounds - bounds[0], data[bounds[0] : bounds[-1]]


def _row(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(ids), dtype="<u4"), np.array([len(x) // 4 for x in ids], dtype=np.int64)


def _gather(row: np.ndarray, size: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The pieces of ``row`` (one after the other, of the given sizes) with these numbers."""
    start = np.cumsum(size) - size
    out = [row[:0]]
    for at in range(0, len(index), GATHER):
        some = index[at : at + GATHER]
        n = size[some]
        place = np.repeat(start[some] - (np.cumsum(n) - n), n)
        place += np.arange(len(place))
        out.append(row[place])
    return np.concatenate(out)


def token_bytes(tokenizer) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary (special tokens: of their string)."""
    byte = {chr(c): b for b, c in _CHARACTER.items()}
    added = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = added[i].encode() if i in added else bytes(byte[c] for c in token)
    return out


def byte_words(path: str, special: bool = False) -> ByteWords:
    """One encoder for each worker process, so that its tasks share the cache."""
    return worker_cache(f"byte words {special} {path}", lambda: ByteWords(path, special))
