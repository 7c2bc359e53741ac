"""Pre-tokens of two tokenizer files and cached encoding by the tokenizers library.

A pre-token's ids do not depend on its neighbours, so a Python worker encodes
each distinct pre-token once (with the library).  No pre-token reaches over the
end of a piece (white space and the word after it) either, so the ids of each
distinct piece are kept in one array, and those of a column of texts are taken
from it by position.  A full cache is emptied.  Plain texts (ASCII and Latin letters)
are split by patterns of the ``re`` module, which are equal to the library's
there and quicker; all other texts by those of ``regex``.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex

from tessella.llm.common import claim_worker
from tessella.llm.words import PieceTable, pieces_of

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
#: Entries of a cache of pre-tokens; of an encoder's pieces with their ids, and of each of its two generations of pre-tokens.
CACHE_ENTRIES, CACHED_PIECES, CACHED_IDS, GENERATION = 700_000, 600_000, 3_500_000, 120_000
#: Longer keys leave the caches after their batch.
LONG = 64

#: Letters of the quick patterns: all code points of these ranges are letters, are in NFC and have a one-letter lower case.
_LATIN = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
#: The control characters 28 to 31 are white space to Python but not to the library.
_QUICK = re.compile(f"[\x00-\x1b\x20-\x7f{_LATIN}]*")
_SPACE = r"\t-\r "


def _patterns(letters: str, lower: str) -> tuple[re.Pattern, re.Pattern]:
    """For the byte-level file and, over lower-case text, for the word file."""
    byte = f" ?[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{_SPACE}{letters}0-9]+| ?[0-9]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
    return re.compile(byte), re.compile(f"[{lower}]+|'s|'t|'re|'ve|'m|'ll|'d|[^{_SPACE}{lower}0-9]+|[0-9]")


_BYTE_ASCII, _WORD_ASCII = _patterns("A-Za-z", "a-z")
_BYTE_QUICK, _WORD_QUICK = _patterns(_LATIN, _LATIN)
_BYTE_ANY = regex.compile(public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
_WORD_ANY = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")


class Pretokenizer:
    """Splits texts as the library does for ``byte_bpe_50k.json`` or ``word_bpe_49k.json``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.path = path
        self.tok = Tokenizer.from_file(path)
        self.normalizer = self.tok.normalizer
        model = json.loads(self.tok.to_str())["model"]
        if model["type"] != "BPE" or (model.get("end_of_word_suffix") or "") != ("</w>" if self.normalizer else ""):
            raise ValueError(f"the pre-tokens of {path} are not known here")
        names = sorted(self.tok.get_vocab(with_added_tokens=True).items(), key=lambda v: v[1])
        self.edge = np.zeros(names[-1][1] + 1, bool)
        self.edge[[i for t, i in names if (t.endswith("</w>") if self.normalizer else t.startswith("Ġ"))]] = True
        self.special = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._ascii, self._quick, self._any = (_WORD_ASCII, _WORD_QUICK, _WORD_ANY) if self.normalizer else (_BYTE_ASCII, _BYTE_QUICK, _BYTE_ANY)

    def plain(self, text: str) -> list[str]:
        """The pre-tokens of a text without special strings; normalised."""
        if text.isascii():
            return self._ascii.findall(text.lower() if self.normalizer else text)
        if _QUICK.fullmatch(text):
            return self._quick.findall(text.lower() if self.normalizer else text)
        return self._any.findall(self.normalizer.normalize_str(text) if self.normalizer else text)

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a text; a special string is one of its own."""
        if "<|" not in text or not self._special:
            return self.plain(text)
        out: list[str] = []
        for i, part in enumerate(self._special.split(text)):
            if i % 2:
                out.append(part)
            elif part:
                out.extend(self.plain(part))
        return out

    def ids(self, pretokens: list[str]) -> list[bytes]:
        """The library's ids of each pre-token by itself, as little-endian unsigned 32-bit bytes."""
        out = [b""] * len(pretokens)
        easy, joined = [], []
        every = "".join(pretokens)
        plain = "<|" not in every and (every.isascii() or _QUICK.fullmatch(every) is not None)
        if plain:  # no special string and nothing to normalise
            keep = [bool(p.strip()) for p in pretokens] if self.normalizer else [p[:1] == " " and not p.isspace() for p in pretokens]
            joined, easy = [i for i, k in enumerate(keep) if k], [i for i, k in enumerate(keep) if not k]
        for i, p in enumerate(() if plain else pretokens):
            if p in self.special:
                out[i] = np.array([self.special[p]], "<u4").tobytes()
            elif self.normalizer and not p.isascii() and not _QUICK.fullmatch(p):  # it is normalised already and must not be so twice
                out[i] = np.array([t.id for piece, _ in self.tok.pre_tokenizer.pre_tokenize_str(p) for t in self.tok.model.tokenize(piece)], "<u4").tobytes()
            elif not p.isspace() and (self.normalizer or p[:1] == " "):
                joined.append(i)
            else:
                easy.append(i)
        for i, e in zip(easy, self.tok.encode_batch_fast([pretokens[i] for i in easy], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, "<u4").tobytes()
        # these stay apart in one text: they begin with a space, or white space between them is dropped
        groups = [[pretokens[i] for i in joined[at : at + 2000]] for at in range(0, len(joined), 2000)]
        encoded = self.tok.encode_batch_fast([(" " if self.normalizer else "").join(g) for g in groups], add_special_tokens=False)
        for at, group, e in zip(range(0, len(joined), 2000), groups, encoded, strict=True):
            ids = np.array(e.ids, "<u4")
            # the first token of each has the space, or the last one the mark of a word's end
            marks = np.flatnonzero(self.edge[ids])
            if len(marks) == len(group) and len(ids) and (marks[-1] + 1 == len(ids) if self.normalizer else marks[0] == 0):
                ends = [0, *(4 * marks + 4).tolist()] if self.normalizer else [*(4 * marks).tolist(), 4 * len(ids)]
                data = ids.tobytes()
                parts = [data[x:y] for x, y in zip(ends, ends[1:], strict=False)]
            else:
                parts = [np.array(x.ids, "<u4").tobytes() for x in self.tok.encode_batch_fast(group, add_special_tokens=False)]
            for i, found in zip(joined[at:], parts, strict=False):
                out[i] = found
        return out


class Cached(Pretokenizer):
    """Values of texts that are the combination of their pre-tokens' values."""

    def __init__(self, path: str):
        super().__init__(path)
        self.cache: dict = {}

    def values(self, pretokens: list[str]) -> list:
        raise NotImplementedError

    def combine(self, values):
        raise NotImplementedError

    def of_texts(self, texts: list[str]) -> list:
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        parts = [self.split(t) for t in texts]
        found = [list(map(self.cache.get, p)) for p in parts]
        missing = list({k for p, f in zip(parts, found, strict=True) if None in f for k, v in zip(p, f, strict=True) if v is None})
        self.cache.update(zip(missing, self.values(missing), strict=True))
        out = [self.combine(map(self.cache.__getitem__, p) if None in f else f) for p, f in zip(parts, found, strict=True)]
        for k in missing:
            if len(k) > LONG:
                del self.cache[k]
        return out


class CachedEncoder(Cached):
    """Ids of whole texts."""

    def __init__(self, path: str):
        super().__init__(path)
        self.older: dict[str, bytes] = {}
        self.table = PieceTable(CACHED_PIECES, CACHED_IDS, LONG)

    def clear(self) -> None:
        self.cache, self.older = {}, {}
        self.table.clear()

    def values(self, pretokens: list[str]) -> list[bytes]:
        return self.ids(pretokens)

    def combine(self, values) -> bytes:
        return b"".join(values)

    def _splits(self, texts: list[str]) -> list[list[str]]:
        joined = "".join(texts)
        plain = self._ascii if joined.isascii() else self._quick if _QUICK.fullmatch(joined) else None
        if "<|" in joined or plain is None:
            return [self.split(t) for t in texts]
        return list(map(plain.findall, map(str.lower, texts) if self.normalizer else texts))

    def of_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece; pre-tokens met lately are not encoded again."""
        texts = [p.decode() for p in pieces]
        # a piece of letters, with or without a space before them, is one pre-token
        words = [t[1:] if t[:1] == " " else t for t in texts]
        if self.normalizer:
            alone = [w.lower() if w.isascii() and w.isalpha() else None for w in words]
        else:
            alone = [t if w.isalpha() else None for t, w in zip(texts, words, strict=True)]
        others = [i for i, a in enumerate(alone) if a is None]
        parts: dict[int, list[str]] = {}
        plain = [i for i in others if texts[i].isascii()]
        wide = [i for i in others if not texts[i].isascii()]
        groups = [plain, wide] if _QUICK.fullmatch("".join(texts[i] for i in wide)) else [plain, [i for i in wide if _QUICK.fullmatch(texts[i])], [i for i in wide if not _QUICK.fullmatch(texts[i])]]
        for group in groups:
            parts.update(zip(group, self._splits([texts[i] for i in group]), strict=True))
        if len(self.cache) > GENERATION:
            self.cache, self.older = {}, self.cache
        wanted = dict.fromkeys(alone)
        wanted.pop(None, None)
        wanted.update(dict.fromkeys(chain.from_iterable(parts.values())))
        missing = [p for p in wanted if p not in self.cache]
        if self.older:
            self.cache.update((p, self.older[p]) for p in missing if p in self.older)
            missing = [p for p in missing if p not in self.older]
        self.cache.update(zip(missing, self.ids(missing), strict=True))
        known = self.cache
        out = [b"".join([known[p] for p in parts[i]]) if a is None else known[a] for i, a in enumerate(alone)]
        for p in missing:
            if len(p) > LONG:
                del known[p]
        return out

    def of_column(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null is empty), after each text ``end_id`` if given, and where each text's ids end."""
        return self.table.take(*pieces_of(texts), self.of_pieces, end_id)


_encoders: dict[str, CachedEncoder] = {}


def encoder(path: str) -> CachedEncoder:
    """This worker's encoder for a tokenizer file; it outlives a task."""
    claim_worker("pretokens", lambda: [e.clear() for e in _encoders.values()])
    if path not in _encoders:
        _encoders[path] = CachedEncoder(path)
    return _encoders[path]
