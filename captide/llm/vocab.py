"""Tokenizing in tasks: texts are cut where no token can cross, pieces are looked up in worker caches.

A byte-level vocabulary never joins a run of non-space characters with the white space after it, so
``white space + non-space run`` is a unit of its own (a *pre-token* here). A vocabulary that drops white
space has its units between white space. Every unit that a worker has not seen yet is encoded by the
tokenizer library itself, so ids are always the library's.
"""

from __future__ import annotations

import functools
import os
import re
import struct

import numpy as np

# The characters that Unicode calls white space (property White_Space).
WHITE = "\t-\r \x85\xa0  -     　"
# A unit takes about 200 bytes of a worker's memory, and an executor has a worker per core.
CACHE_UNITS = 1 << 19
# Units that are new to a worker are kept from their second time on: most come once. SEEN bytes remember the first.
SEEN = 1 << 23
# Plain words: letters of one normal form each, with at most one punctuation mark behind them.
LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha() and c not in "ªµº")
POINTS = ".,;:!?"
# The last word of each place is kept: other units have the same letters.
WORDS = 1 << 16
_FORMATS = [f"<{n}I" for n in range(16)]
_WORD = re.compile(f"([{LETTERS}]+)([{POINTS}]?)").fullmatch


def _split(text: str) -> list[bytes]:
    return text.encode().split()


class UnitEncoder:
    """Ids of texts under one tokenizers file, by a bounded cache of units.

    ``keeps_space`` says that white space belongs to tokens (byte-level vocabularies).
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keeps_space = self.tokenizer.normalizer is None
        self.letters, self.points = self._plain()
        self.seen = bytearray(SEEN)
        self.words: list[tuple[str, bytes] | None] = [None] * WORDS
        self.cache: dict[str | bytes, bytes] = {}
        self.lengths: dict[str | bytes, int] = {}
        # Without white space, units are cut at ASCII white space, on which the library and Python agree.
        self.units = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+").findall if self.keeps_space else _split

    def _encode(self, units: list) -> list[list[int]]:
        texts = units if self.keeps_space else [unit.decode() for unit in units]
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _packed(self, units: list) -> list[bytes]:
        """The ids of each unit, packed."""
        return [np.array(ids, dtype="<u4").tobytes() for ids in self._encode(units)]

    def _plain(self) -> tuple[dict | None, dict]:
        """What the library makes of each letter before its model, and the ids of each point; no letters if they do not part so.

        Then the model alone gives the ids of a plain word, without the cost of a whole call.
        """
        if self.keeps_space or self.tokenizer.pre_tokenizer is None:
            return None, {}

        def parts(text: str) -> list[str]:
            return [part for part, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))]

        letters = {ord(c): "".join(parts(c)) for c in LETTERS}
        for point in POINTS:
            if parts(LETTERS + point) != [LETTERS.translate(letters), *parts(point)]:
                return None, {}
        added = {token.content for token in self.tokenizer.get_added_tokens_decoder().values()}
        if any(_WORD(token) for token in added):
            return None, {}
        return letters, dict(zip(POINTS, self._packed(list(POINTS.encode()[i : i + 1] for i in range(len(POINTS)))))) | {"": b""}

    def encoded(self, units: list) -> dict:
        """The ids of different units, packed."""
        if self.letters is None:
            return dict(zip(units, self._packed(units)))
        known, apart, tokenize, points = {}, [], self.tokenizer.model.tokenize, self.points
        found = list(map(_WORD, map(bytes.decode, units)))
        # The words of all units are brought to their normal form at once.
        plain = iter("\n".join([word[1] for word in found if word]).translate(self.letters).split("\n"))
        words = self.words
        for unit, word in zip(units, found):
            if word:
                letters = next(plain)
                place = hash(letters) % WORDS
                kept = words[place]
                if kept is None or kept[0] != letters:
                    ids = [token.id for token in tokenize(letters)]
                    kept = words[place] = letters, struct.pack(_FORMATS[len(ids)] if len(ids) < 16 else f"<{len(ids)}I", *ids)
                known[unit] = kept[1] + points[word[2]] if word[2] else kept[1]
            else:
                apart.append(unit)
        if apart:
            known.update(zip(apart, self._packed(apart)))
        return known

    def ids(self, text: str) -> bytes:
        """The ids of a text, packed as little-endian unsigned 32-bit integers."""
        cache, seen = self.cache, self.seen
        units = self.units(text)
        found = list(map(cache.get, units))
        if None in found:
            missing = [at for at, ids in enumerate(found) if ids is None]
            new = self.encoded(list(dict.fromkeys([units[at] for at in missing])))
            for at in missing:
                found[at] = new[units[at]]
            for unit, ids in new.items():
                place = hash(unit) % SEEN
                if not seen[place]:
                    seen[place] = 1
                else:
                    if len(cache) >= CACHE_UNITS:
                        cache.clear()
                        seen[:] = bytes(SEEN)
                    cache[unit] = ids
        return b"".join(found)

    def count(self, text: str, frequent: dict) -> int:
        """How many ids a text has: the frequent units first, then the worker's cache, then the library."""
        lengths = self.lengths
        units = self.units(text)
        try:
            return sum([frequent[unit] for unit in units])
        except KeyError:
            pass
        total, rare = 0, []
        look = frequent.get
        for unit in units:
            n = look(unit)
            if n is None:
                rare.append(unit)
            else:
                total += n
        missing = list(dict.fromkeys(unit for unit in rare if unit not in lengths))
        if missing:
            if len(lengths) + len(missing) > 2 * CACHE_UNITS:
                lengths.clear()
                missing = list(dict.fromkeys(rare))
            for unit, ids in zip(missing, self._encode(missing)):
                lengths[unit] = len(ids)
        return total + sum(map(lengths.__getitem__, rare))


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> UnitEncoder:
    """The encoder of this worker process: its caches live as long as the worker."""
    return UnitEncoder(path)
