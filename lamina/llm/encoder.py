"""Token ids of whole texts by a tokenizer file, remembering words and pieces it has encoded before.

The tokenizer encodes pieces of a text one by one where that provably gives the ids of the whole:
the file must split texts into letter runs, single digits and runs of other characters after lower
casing, none of which holds white space, and mark the ends of pieces. For texts of Latin-1 characters words and their
pieces are found here, each different word of a batch of texts is looked up once, and each different piece is given to
the tokenizer once, those that a batch has new together; every other text is encoded as a whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Sequence
from functools import lru_cache
from itertools import chain, compress
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lamina.llm.words import slices

_LETTERS = "a-zªµºß-öø-ÿ"
_NUMBERS = "0-9²³¹¼-¾"
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+")
# Separators on which the regular expression dialects do not agree, what is not Latin-1, and the start of special tokens.
_UNSURE = r"[\x1c-\x1f\x{85}\x{a0}\x{100}-\x{10ffff}]|<\|"
TOGETHER = 1 << 22  # bytes of text whose different words are looked up at once
_REMEMBERED = 1_600_000
_LONGEST = 64  # characters of a word or piece that is remembered
_JOINED = 2000  # pieces encoded as one text
# What the memo is good for, as the tokenizer file says it.
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


class Encoder:
    """``encode`` gives the ids of a text as little-endian unsigned 32-bit integers.

    ``literal`` takes the strings of special tokens in a text as ordinary text. The memo holds
    about 1,600,000 words and pieces; beyond, those go that have not been met for half as many new ones.
    """

    def __init__(self, path: str, literal: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        splits = [s["pattern"].get("Regex") for s in steps if s["type"] == "Split"]
        names = [s["type"] for s in (spec.get("normalizer") or {}).get("normalizers", [])]
        suffix = spec["model"].get("end_of_word_suffix")
        self._by_piece = splits == [_SPLIT] and names == ["NFC", "Replace", "Lowercase"] and bool(suffix)
        if self._by_piece:
            vocabulary = spec["model"]["vocab"]
            self._last = np.zeros(max(vocabulary.values()) + 1, bool)
            self._last[[number for token, number in vocabulary.items() if token.endswith(suffix)]] = True
            # Pieces are lower case already, hold no white space and no character that NFC changes.
            self._lean = Tokenizer(self.tokenizer.model)
            self._lean.pre_tokenizer = self.tokenizer.pre_tokenizer
        self._memo = _Memo()

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of several texts; null and empty ones have none."""
        ids, ends = self.encode_column(pa.array(texts, pa.large_string()))
        raw, bounds = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column, one after the other, and the end of each text among them."""
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, _UNSURE) if self._by_piece else pa.array(np.ones(len(texts), bool))
        ids, ends = self._by_words(texts.filter(pc.invert(whole)))
        if len(ends) == len(texts):
            return ids, ends
        starts = [0, *ends.tolist()]
        by_words = (ids[a:b] for a, b in zip(starts, starts[1:]))
        # An encoding takes far more room than its text.
        parts = slices(pa.record_batch([texts.filter(whole)], ["text"]), "text")
        at_once = chain.from_iterable(_ids(self.tokenizer, x.column("text").to_pylist()) for x in parts)
        found = [np.frombuffer(next(at_once), "<u4") if w else next(by_words) for w in whole.to_pylist()]
        return np.concatenate(found), np.cumsum([len(x) for x in found])

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each different word of these texts is looked up once; its ids are dealt out to all its places."""
        split = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        words = split.flatten().dictionary_encode()
        last = np.cumsum(pc.list_value_length(split).to_numpy(), dtype=np.int64)
        if not len(words):
            return np.zeros(0, "<u4"), last
        ids = self._look_up(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        firsts = np.cumsum(sizes) - sizes
        of = words.indices.to_numpy()
        n = sizes[of]
        ends = np.cumsum(n)
        at = np.repeat(firsts[of] - (ends - n), n)
        at += np.arange(len(at))
        return np.frombuffer(b"".join(ids), "<u4")[at], np.concatenate(([0], ends))[last]

    def _look_up(self, words: list[str]) -> list[bytes]:
        """Ids of different words; an empty one has none."""
        self._memo.turn()
        ids = list(map(self._memo.held.get, words))
        # Words without ids are those not in the memo.
        unmet = list(compress(range(len(words)), map(not_, ids)))
        long = self._learn(set(map(words.__getitem__, unmet)) - {""})
        for i in unmet:
            ids[i] = self._memo.held.get(words[i], b"")
        self._memo.forget(long)
        return ids

    def _learn(self, words: set[str]) -> list[str]:
        """Have all these words in the memo; returns what is too long to stay there.

        A word of letters is a piece, and a piece as a word is that piece alone, so one memo holds both.
        """
        known = self._memo.held
        fresh = self._memo.missing(words)
        new = set(filter(str.isalpha, fresh))
        mixed = list(fresh.difference(new))
        pieces = list(map(_PIECE.findall, mixed))
        new |= self._memo.missing(set().union(*pieces).difference(new))
        listed = list(new)
        for first in range(0, len(listed), _JOINED):
            some = listed[first : first + _JOINED]
            known.update(zip(some, self._joined(some)))
        of = known.__getitem__
        known.update([(w, b"".join(map(of, own))) for w, own in zip(mixed, pieces)])
        new.update(mixed)
        return [w for w in new if len(w) > _LONGEST]

    def _joined(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, encoded as one text and parted at the ends of words."""
        [ids] = _ids(self._lean, [" ".join(pieces)])
        ends = np.flatnonzero(self._last[np.frombuffer(ids, "<u4")]) + 1
        if len(ends) != len(pieces):  # a piece whose end no token tells
            return _ids(self._lean, pieces)
        ends = (4 * ends).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]


def _ids(tokenizer, texts: list[str]) -> list[bytes]:
    found = tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
    return [np.array(e.ids, "<u4").tobytes() for e in found]


class _Memo:
    """What was met last, in two generations: the older one goes when the newer one is full."""

    def __init__(self):
        self.held: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def turn(self) -> None:
        if len(self.held) > _REMEMBERED // 2:
            self._older, self.held = self.held, {}

    def missing(self, wanted: set[str]) -> set[str]:
        """Which of the wanted are in neither generation; those of the older one move to the newer."""
        fresh = wanted.difference(self.held)
        # An intersection with a dictionary would go through all of the older ones.
        again = set(filter(self._older.__contains__, fresh))
        self.held.update((w, self._older[w]) for w in again)
        return fresh.difference(again)

    def forget(self, names: list[str]) -> None:
        for name in names:
            del self.held[name]


@lru_cache(maxsize=1)
def shared_encoder(path: str, literal: bool = False) -> Encoder:
    """The encoder of this process; the tasks that run in it one after the other share its memo."""
    return Encoder(path, literal)
