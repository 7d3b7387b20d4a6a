"""Byte-pair encoding of distinct pieces of text, sharing the work of common prefixes.

A text is normalized and cut into pieces (words, digits, runs of signs); equal pieces have
equal ids, so only distinct pieces are encoded. ``TrieEncoder`` does that for all distinct
pieces of a batch at once: the encoding of any prefix is known from its last token alone,
because a token may follow another exactly if encoding both together gives the two again.
So the last token of a prefix, found once, serves every piece that goes on from there.
Sorted pieces are a trie in depth-first order, and a stack of the last tokens along the
current path is all the state there is. ``MergeEncoder`` merges piece by piece in native
code, where only the ids matter.

Only vocabularies with word ends whose ids follow the order of the merges are accepted.
"""

from __future__ import annotations

import json
import os.path
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import regex
import tiktoken

END = "</w>"
# never a byte of a UTF-8 text, so it can stand for the end of a word
END_BYTE = b"\xff"
# the same in texts of many pieces that have no such sign
END_SIGN = "\x01"
# bounds of what a worker keeps between batches
CACHE_PIECES = 400_000
CACHE_PAIRS = 1_000_000
BATCH_CHARS = 4_000_000

_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# the same for texts of Latin letters, by plain character sets, which are faster
_LATIN = 0x250


def _latin_pieces() -> re.Pattern[str]:
    def every(kind: str) -> str:
        return "".join(re.escape(c) for c in map(chr, range(_LATIN)) if regex.fullmatch(kind, c))

    letters, digits, blanks = every(r"\p{L}"), every(r"\p{N}"), every(r"\s")
    return re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{blanks}{letters}{digits}]+")


_LATIN_PIECES = _latin_pieces()
# what a text of many words may have: signs, digits and letters up to U+024F that stay there in lower case
_PLAIN = "".join(re.escape(c) for c in map(chr, range(0x21, _LATIN)) if not 0x7F <= ord(c) <= 0xA0 and c != "<" and len(c.lower()) == 1 and ord(c.lower()) < _LATIN)
_NOT_PLAIN = re.compile(f"[^\n{_PLAIN}]")
_BEYOND_LATIN = re.compile(rf"[^\x00-{chr(_LATIN - 1)}]")


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = set(printable)
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class PieceEncoder:
    """Normalization, pieces and tokens of a vocabulary in the tokenizers JSON format."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model, cut = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END or cut["pattern"]["Regex"] != _PIECES:
            raise ValueError("a BPE vocabulary with word ends is expected")
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in {**self.vocab, **self.special}.items()}
        self.size = max(self.tokens) + 1
        self.base = len(self.vocab) - len(model["merges"])
        self.merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(self.vocab[a + b] != self.base + rank for rank, (a, b) in enumerate(self.merges)):
            raise ValueError("token ids must follow the order of the merges")
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self._cut = regex.compile(_PIECES)
        self._symbols = _byte_symbols()

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text, special tokens among them; equal pieces have equal ids."""
        if "<|" in text and self._special.search(text):
            parts = self._special.split(text)
            return [p for part in parts for p in ([part] if part in self.special else self._plain_pieces(part))]
        return self._plain_pieces(text)

    def _plain_pieces(self, text: str) -> list[str]:
        if not text.isascii():
            # case is mapped character by character, so a capital sigma has one small form
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        if text.isascii() or not _BEYOND_LATIN.search(text):
            return _LATIN_PIECES.findall(text)
        return self._cut.findall(text)

    def encode(self, pieces: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """The ids of distinct pieces."""
        ids = {p: (self.special[p],) for p in pieces if p in self.special}
        ids.update(self._encode_plain([p for p in pieces if p not in ids]))
        return ids

    def _encode_plain(self, pieces: list[str]) -> Iterable[tuple[str, tuple[int, ...]]]:
        raise NotImplementedError


class MergeEncoder(PieceEncoder):
    def __init__(self, definition: str):
        super().__init__(definition)
        byte_of = {s: b for b, s in enumerate(self._symbols)}

        def as_bytes(token: str, end: bytes) -> bytes:
            ends = token.endswith(END)
            return bytes(byte_of[c] for c in token.removesuffix(END)) + end * ends

        def merges(end: bytes, pattern: str) -> tiktoken.Encoding:
            ranks = {as_bytes(t, end): i for t, i in self.vocab.items()}
            return tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

        self._merge = merges(END_BYTE, r"\S+")
        self._merges = merges
        self._together: tiktoken.Encoding | None = None

    def words_together(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """The ids of words one after the other, how many each has, and which were left out, with none.

        Words have no white space. Left out are those with other signs than plain ones.
        """
        if self._together is None:
            self._together = self._merges(END_SIGN.encode(), r"[^ \n]+")
            self._ends = np.zeros(self.size, bool)
            self._ends[[i for t, i in self.vocab.items() if t.endswith(END)]] = True
        text = b"\n".join(words).decode()
        left: list[int] = []
        if odd := [m.start() for m in _NOT_PLAIN.finditer(text)]:
            firsts = np.cumsum([0, *(len(w) + 1 for w in text.split("\n"))])
            left = np.unique(np.searchsorted(firsts, odd, "right") - 1).tolist()
            words = list(words)
            for i in left:
                words[i] = b""
            text = b"\n".join(words).decode()
        text = _LATIN_PIECES.sub(rf"\g<0>{END_SIGN} ", text.lower())
        ids = np.array(self._together._core_bpe.encode_ordinary(text), np.int64)
        data = np.frombuffer(text.encode(), np.uint8)
        word_of_piece = np.cumsum(data == 10)[data == ord(END_SIGN)]
        last = self._ends[ids]
        return ids, np.bincount(word_of_piece[np.cumsum(last) - last], minlength=len(words)), left

    def piece_ids(self, piece: bytes) -> list[int]:
        """The ids of one piece, normalized already."""
        return self._merge._core_bpe.encode_single_piece(piece + END_BYTE)

    def _encode_plain(self, pieces: list[str]) -> Iterable[tuple[str, tuple[int, ...]]]:
        merge = self._merge._encode_single_piece
        return ((p, tuple(merge(p.encode() + END_BYTE))) for p in pieces)


class TrieEncoder(PieceEncoder):
    def __init__(self, definition: str):
        super().__init__(definition)
        self._merged: dict[int, int] = {}
        self._left: dict[int, int] = {}
        self._right: dict[int, int] = {}
        for rank, (a, b) in enumerate(self.merges):
            left, right, whole = self.vocab[a], self.vocab[b], self.base + rank
            self._merged[left << 32 | right] = whole
            self._left[whole], self._right[whole] = left, right
        self._inner = {t: i for t, i in self.vocab.items() if not t.endswith(END)}
        self._final = {t.removesuffix(END): i for t, i in self.vocab.items() if t.endswith(END)}
        self._longest = max(map(len, (*self._inner, *self._final)))
        self._pairs: dict[int, bool] = {}  # whether a token may follow another

    def _may_follow(self, first: int, second: int) -> bool:
        """Whether the two tokens side by side stay as they are.

        Undo their merges, latest first: if what then meets at the boundary would have
        merged before the merge just undone, the two never both come to be. Equal merges
        are applied from the left.
        """
        base, merged, before = self.base, self._merged, self.size
        while True:
            whole = merged.get(first << 32 | second)
            if whole is not None and whole < before:
                return False
            if first > second:
                if first < base:
                    return True
                before, first = first, self._right[first]
            else:
                if second < base:
                    return True
                before, second = second + 1, self._left[second]

    def _in_symbols(self, piece: str) -> str:
        if piece.isascii() and piece.isprintable():
            return piece
        return "".join([self._symbols[b] for b in piece.encode()])

    def _encode_plain(self, pieces: list[str]) -> Iterable[tuple[str, tuple[int, ...]]]:
        in_order = sorted((self._in_symbols(p), p) for p in pieces)
        return zip((p for _, p in in_order), self._depth_first([s for s, _ in in_order]))

    def _depth_first(self, words: list[str]) -> Iterator[tuple[int, ...]]:
        """Ids of sorted, distinct, non-empty words of byte symbols."""
        longest, inner, fits = self._longest, self._inner, self._may_follow
        if len(self._pairs) > CACHE_PAIRS:
            self._pairs = {}
        pairs = self._pairs
        last: list[int] = [-1]  # last token of each prefix on the current path
        size: list[int] = [0]  # and how many symbols it covers

        def token_at(table: dict[str, int], word: str, end: int) -> tuple[int, int]:
            """The one token that may stand at ``end``, and its start; likely starts come first."""
            grown = end - 1 - size[end - 1]
            for starts in ((grown, end - 1), range(grown + 1, end - 1), range(max(0, end - longest), grown)):
                for start in starts:
                    token = table.get(word[start:end])
                    if token is not None:
                        prior = last[start]
                        if prior < 0:
                            return token, start
                        ok = pairs.get(prior << 32 | token)
                        if ok is None:
                            ok = pairs[prior << 32 | token] = fits(prior, token)
                        if ok:
                            return token, start
            raise ValueError(f"the vocabulary lacks symbols of {word!r}")

        before = ""
        for word in words:
            shared = min(len(os.path.commonprefix((word, before))), len(last) - 1, len(word) - 1)
            del last[shared + 1 :], size[shared + 1 :]
            for end in range(shared + 1, len(word)):
                token, start = token_at(inner, word, end)
                last.append(token)
                size.append(end - start)
            token, at = token_at(self._final, word, len(word))
            ids = [token]
            while at:
                ids.append(last[at])
                at -= size[at]
            ids.reverse()
            yield tuple(ids)
            before = word


class PieceCache:
    """Values made from the ids of pieces, at most ``limit`` of them between batches."""

    def __init__(self, encoder: PieceEncoder, make: Callable[[tuple[int, ...]], object], limit: int = CACHE_PIECES):
        self.encoder, self.make, self.limit = encoder, make, limit
        self.known: dict[str, object] = {}

    def values(self, texts: Iterable[str], chars: int = BATCH_CHARS) -> Iterator[list]:
        """For each text the values of its pieces; new pieces of ``chars`` of text are encoded together."""
        batch: list[list[str]] = []
        held = 0
        for text in texts:
            batch.append(self.encoder.pieces(text))
            held += len(text)
            if held >= chars:
                yield from self._values(batch)
                batch, held = [], 0
        yield from self._values(batch)

    def _values(self, batch: list[list[str]]) -> Iterator[list]:
        found = set().union(*batch)
        new = found.difference(self.known)
        if len(self.known) + len(new) > self.limit:
            self.known, new = {}, found
        make = self.make
        self.known.update((p, make(ids)) for p, ids in self.encoder.encode(new).items())
        for pieces in batch:
            yield list(map(self.known.__getitem__, pieces))

    def values_of_words(self, texts: Iterable[list[bytes]]) -> Iterator[list]:
        """The same for texts given as words, with one value for each word."""
        join = self.make
        batch = list(texts)
        found = set().union(*batch)
        new = found.difference(self.known)
        if len(self.known) + len(new) > self.limit:
            self.known, new = {}, found
        pieces = {word: self.encoder.pieces(word.decode()) for word in new}
        ids = self.encoder.encode(set().union(*pieces.values()))
        self.known.update((w, join(tuple(i for p in own for i in ids[p]))) for w, own in pieces.items())
        for words in batch:
            yield list(map(self.known.__getitem__, words))
